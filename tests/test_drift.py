"""Trailing windows over mergeable parts, against results computed from the rows."""

import math
import random
from bisect import bisect_left, bisect_right
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from authweave.operators import drift

LOGONS = "src_user string, day_index int, hour int, second_of_day int, is_logon int"


def logons(spark, rows):
    return spark.createDataFrame([(u, d, h, h * 3600, 1) for u, d, h in rows], LOGONS)


def by_day(frame):
    return {(r.src_user, r.day_index): r for r in frame.collect()}


def test_hours_of_a_lone_logon_and_of_equal_days(spark):
    rows = [("lone", 3, 5)]
    rows += [("same", d, h) for d in range(4) for h in (8, 9, 9, 17)]
    rows += [("moved", 0, 8), ("moved", 1, 20), ("back", 0, 8), ("back", 9, 8)]
    found = by_day(drift.hour_drift(drift.hour_histograms(logons(spark, rows))))
    lone = found["lone", 3]
    assert (lone.logons, lone.active_hours, lone.entropy, lone.baseline_logons, lone.js_distance) == (1, 1, 0.0, 0, None)
    assert [found["same", d].js_distance for d in range(4)] == [None, 0.0, 0.0, 0.0]
    assert found["same", 3].baseline_logons == 12 and found["same", 0].entropy == 1.5
    assert found["moved", 1].js_distance == 1.0
    assert found["back", 9].js_distance is None  # nine days before are out of the window


def test_hours_equal_brute_force(spark):
    random.seed(4)
    rows = [(f"u{random.randrange(6)}", random.randrange(20), int(random.gauss(12, 5)) % 24) for _ in range(2_000)]
    rows += [("hot", random.randrange(20), random.randrange(24)) for _ in range(1_000)]
    found = by_day(drift.hour_drift(drift.hour_histograms(logons(spark, rows))))
    counts = defaultdict(lambda: [0] * 24)
    for user, day, hour in rows:
        counts[user, day][hour] += 1

    def entropy(shares):
        return -sum(p * math.log2(p) for p in shares if p)

    assert set(found) == set(counts)
    for (user, day), row in found.items():
        p = [n / sum(counts[user, day]) for n in counts[user, day]]
        before = [sum(counts[user, d][h] for d in range(day - 7, day) if (user, d) in found) for h in range(24)]
        assert row.entropy == pytest.approx(entropy(p), abs=2e-6)
        assert row.baseline_logons == sum(before)
        if sum(before):
            q = [n / sum(before) for n in before]
            js = entropy([(a + b) / 2 for a, b in zip(p, q)]) - (entropy(p) + entropy(q)) / 2
            assert row.js_distance == pytest.approx(math.sqrt(max(js, 0)), abs=2e-6)
        else:
            assert row.js_distance is None


def test_histograms_merge_over_days(spark):
    """Parts of two halves of the log, added up, are the parts of the whole."""
    random.seed(6)
    rows = [("u", random.randrange(3), random.randrange(24)) for _ in range(500)]
    halves = [drift.hour_histograms(logons(spark, part)) for part in (rows[:200], rows[200:])]
    names = [name for name in halves[0].columns if name not in ("src_user", "day_index")]
    merged = halves[0].unionByName(halves[1]).groupBy("src_user", "day_index").agg(*[F.sum(n).alias(n) for n in names])
    assert merged.exceptAll(drift.hour_histograms(logons(spark, rows))).count() == 0


def values(spark, users, seed):
    return spark.range(0, users * 40_000, 1, 8).select(
        F.concat(F.lit("u"), F.col("id") % users).alias("src_user"),
        F.expr(f"CAST(pmod(xxhash64(id, {seed}), 9) AS INT)").alias("day_index"),
        F.expr(f"CAST(sqrt(pmod(xxhash64(id, {seed + 1}), 7464960000)) AS INT)").alias("second_of_day"),
    )


def test_rank_error_of_merged_sketches(spark):
    """Far above k values: quantiles stay within 0.6 % of their rank (twice the stated 0.3 %)."""
    rows = values(spark, 2, 1).cache()
    found = by_day(drift.robust_baselines(drift.daily_sketches(rows)))
    exact = by_day(drift.exact_baselines(rows))
    lists = defaultdict(list)
    for row in rows.collect():
        lists[row.src_user, row.day_index].append(row.second_of_day)
    worst = 0.0
    assert set(found) == set(exact) == set(lists)
    for (user, day), row in found.items():
        assert not row.exact
        before = sorted(v for d in range(day - 7, day) for v in lists.get((user, d), ()))
        true = exact[user, day]
        own = sorted(lists[user, day])
        assert true.median == own[math.ceil(0.5 * len(own)) - 1] and true.baseline_n == row.baseline_n == len(before)
        for name, rank in (("baseline_p25", 0.25), ("baseline_median", 0.5), ("baseline_p75", 0.75)):
            if before:
                assert true[name] == before[math.ceil(rank * len(before)) - 1]
                low, high = (f(before, row[name]) / len(before) for f in (bisect_left, bisect_right))
                worst = max(worst, low - rank, rank - high)
            else:
                assert true[name] is None and row[name] is None
    print("worst rank error", worst)
    assert worst <= 0.006


def test_small_users_are_exact(spark):
    rows = values(spark, 300, 3).filter("pmod(xxhash64(src_user, second_of_day), 101) = 0")
    rows = rows.unionByName(spark.createDataFrame([("one", 4, 77), ("gap", 0, 5), ("gap", 8, 5), ("gap", 9, None)], rows.schema))
    found, exact = drift.robust_baselines(drift.daily_sketches(rows)), drift.exact_baselines(rows)
    assert found.filter("NOT exact").count() == 0
    assert found.exceptAll(exact).count() == 0 and exact.exceptAll(found).count() == 0
    rows = by_day(found)
    assert rows["one", 4].median == 77 and rows["one", 4].baseline_n == 0 and rows["one", 4].deviation is None
    assert rows["gap", 8].baseline_median is None and ("gap", 9) not in rows


def test_trailing_hosts(spark):
    random.seed(8)
    visits = {(f"u{random.randrange(5)}", f"C{int(random.expovariate(0.05))}", random.randrange(25)) for _ in range(1_500)}
    visits |= {("once", "C1", 3), ("again", "C1", 0), ("again", "C1", 7), ("again", "C2", 6)}
    edges = spark.createDataFrame(sorted(visits), "src_user string, dst_computer string, day_index int")
    exact = by_day(drift.trailing_hosts(edges))
    estimated = by_day(drift.trailing_hosts_estimated(drift.host_sketches(edges)))
    assert set(exact) == set(estimated) == {(u, d) for u, _, d in visits}
    for (user, day), row in exact.items():
        assert row.hosts == len({h for u, h, d in visits if (u, d) == (user, day)})
        assert row.trailing_hosts == len({h for u, h, d in visits if u == user and day - 7 < d <= day})
        assert row == estimated[user, day]


def test_relative_error_of_many_hosts(spark):
    edges = spark.range(0, 400_000, 1, 8).select(
        F.concat(F.lit("u"), F.col("id") % 4).alias("src_user"),
        F.concat(F.lit("C"), F.expr("pmod(xxhash64(id), 60000)")).alias("dst_computer"),
        F.expr("CAST(pmod(xxhash64(id, 5), 10) AS INT)").alias("day_index"),
    ).distinct()
    exact = by_day(drift.trailing_hosts(edges))
    estimated = by_day(drift.trailing_hosts_estimated(drift.host_sketches(edges)))
    errors = [abs(estimated[key].trailing_hosts / row.trailing_hosts - 1) for key, row in exact.items()]
    print("worst relative error", max(errors))
    assert min(row.trailing_hosts for row in exact.values()) > 5_000 and max(errors) < 0.06
