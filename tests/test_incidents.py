import random
from collections import defaultdict

from authweave.operators import incidents

SCHEMA = "user string, time long, dst_computer string, score double, auth_count long, failed_count long"


def found(spark, rows, **options):
    frame = spark.createDataFrame([(u, t, h, s, 1, 1 if t and t % 2 else 0) for u, t, h, s in rows], SCHEMA)
    return incidents.incidents(frame, **options).orderBy("user", "first_time", "part").collect()


def test_gaps_split_and_touching_alerts_join(spark):
    rows = [("U", t, "C", 0.5) for t in (0, 100, 200, 301, 1_000)] + [("V", 100, "C", 1.0), ("U", None, "C", 1.0)]
    spans = [(r.user, r.first_time, r.last_time, r.alerts) for r in found(spark, rows, gap=100)]
    assert spans == [("U", 0, 200, 3), ("U", 301, 301, 1), ("U", 1_000, 1_000, 1), ("V", 100, 100, 1)]


def test_long_incidents_have_several_rows(spark):
    random.seed(1)
    rows = [(f"U{random.randrange(3)}", random.randrange(50) * 40, f"C{random.randrange(5)}", random.random()) for _ in range(300)]
    parts = defaultdict(list)
    for row in found(spark, rows, gap=60, listed=4):
        assert 1 <= len(row.listed) <= 4 and row.part == len(parts[row.user, row.first_time])
        parts[row.user, row.first_time].append(row)
    listed = []
    for (user, first), own in parts.items():
        alerts = [(a.time, a.dst_computer, a.score) for row in own for a in row.listed]
        assert alerts == sorted(alerts) and len(alerts) == own[0].alerts and all(len(r.listed) == 4 for r in own[:-1])
        assert alerts[0][0] == first and alerts[-1][0] == own[0].last_time
        assert all(b[0] - a[0] <= 60 for a, b in zip(alerts, alerts[1:]))
        assert own[0].worst_score == max(a[2] for a in alerts) and own[0].auth_count == len(alerts)
        listed += [(user, *a) for a in alerts]
    assert sorted(listed) == sorted(rows)


def test_no_alerts(spark):
    assert found(spark, []) == []
