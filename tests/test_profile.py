import random

from authweave.operators import profile, staging

ROWS = [(3, "a"), (1, None), (None, "a"), (1, "b"), (2, ""), (None, None)]


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, "time long, v string")


def test_missing_and_distinct(spark):
    assert tuple(profile.missing_values(table(spark), ["time", "v"]).first()) == (2, 2)
    assert tuple(profile.distinct_values(table(spark), ["time", "v"], True).first()) == (4, 4)
    assert tuple(profile.distinct_values(table(spark), ["time", "v"], False).first()) == (3, 3)


def test_empty_input_gives_zeros(spark):
    empty = table(spark).limit(0)
    assert tuple(profile.missing_values(empty, ["time", "v"]).first()) == (0, 0)
    assert tuple(profile.distinct_values(empty, ["time", "v"], True).first()) == (0, 0)
    assert tuple(staging.staging_counts(empty, 7).first()) == (0, 0)
    assert tuple(profile.time_range(empty).first()) == (None, None)


def test_frequencies_break_ties_by_value(spark):
    assert [tuple(r) for r in profile.frequencies(table(spark), "v").collect()] == [
        ("a", 2), (None, 2), ("", 1), ("b", 1)]
    assert [tuple(r) for r in profile.most_frequent(table(spark), "v", 1).collect()] == [("a", 2)]


def test_first_rows(spark):
    random.seed(2)
    rows = [(None if i % 10 == 0 else 7 if i % 3 == 0 else random.randrange(20), f"v{i:03d}")
            for i in range(600)]
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    log = table(spark, rows).repartition(6)
    for count in (1, 10, 250, 540, 541, 600, 700):
        found = [tuple(r) for r in profile.first_rows(log, count, ["v"]).collect()]
        assert found == ordered[:count]


def test_reader_stops_one_row_after_the_limit(spark):
    auth = spark.createDataFrame([(1,), (5,), (6,), (9,), (None,)], "time long")
    process = spark.createDataFrame([(1,), (305,), (306,), (400,)], "time long")
    events = spark.createDataFrame([(2,), (5,)], "time long")
    assert tuple(staging.scan_counts(auth, process, events).first()) == (3, 3)
    late = spark.createDataFrame([(500,)], "time long")
    assert tuple(staging.scan_counts(auth, process, late).first()) == (4, 4)
    assert tuple(staging.scan_counts(auth.limit(0), process, late).first()) == (0, 4)


def test_daily_retention(spark):
    staged = spark.createDataFrame([(0, 4), (1, 3)], "day_index int, rows long")
    clean = spark.createDataFrame([(0, 3), (2, 5), (9, 1)], "day_index int, rows long")
    rows = staging.daily_retention(staged, clean, 3).orderBy("day_index").collect()
    assert [tuple(r) for r in rows] == [
        (0, 4, 3, 1, 75.0), (1, 3, 0, 3, 0.0), (2, 0, 5, -5, None)]


def test_counts_of_billions_a_day(spark):
    from authweave.operators import behavior
    rows = [("U1", day, 4_000_000_000 + day) for day in range(9)]
    activity = spark.createDataFrame(rows, "src_user string, day_index int, auth_count long")
    found = {r.day_index: r for r in behavior.baselines(activity).collect()}
    assert found[8].baseline_days == 7 and found[8].baseline_mean == 4_000_000_004.0
    assert abs(found[8].baseline_stddev - 2.160247) < 1e-6
