import random

import pytest
from pyspark.sql import functions as F

from authweave.operators import clean, graph, redteam
from authweave.schemas import AUTH_SCHEMA, REDTEAM_SCHEMA

AUTH = [
    (10, "U1@D", "U1@D", "C1", "C2", "NTLM", "Network", "LogOn", "Success"),
    (10, "U1@D", "U9@D", "C1", "C2", "NTLM", "Network", "LogOn", "Fail"),
    (10, "u1@d", "U9@D", "C1", "C2", "NTLM", "Network", "LogOn", "Fail"),
    (11, "U1@D", "U1@D", "C1", "C2", None, None, None, None),
    (12, None, "U1@D", "C1", "C2", None, None, None, None),
    (13, "U2@D", "U1@D", "C1", None, None, None, None, None),
]
ATTACKS = [
    (10, "U1@D", "C1", "C2"), (10, "U1@D", "C1", "C2"), (11, "u1@d ", "C1", "C2"),
    (12, None, "C1", "C2"), (99, "U1@D", "C1", "C2"), (None, "U1@D", "C1", "C2"),
]


@pytest.fixture
def auth(spark):
    return spark.createDataFrame(AUTH, AUTH_SCHEMA)


@pytest.fixture
def attacks(spark):
    return spark.createDataFrame(ATTACKS, REDTEAM_SCHEMA)


def check_matching(auth, attacks):
    events = redteam.number_events(attacks.filter("user IS NOT NULL"))
    counts = {r.redteam_id: r.matches for r in redteam.matches_per_event(auth, events).collect()}
    assert counts == {1: 2, 2: 2, 3: 0, 4: 0}
    rows = redteam.raw_matches(auth, events).collect()
    assert sorted((r.redteam_id, r.dst_user) for r in rows) == [
        (1, "U1@D"), (1, "U9@D"), (2, "U1@D"), (2, "U9@D")]
    assert sorted(r.redteam_id for r in redteam.unmatched_events(auth, events).collect()) == [3, 4]
    rate = redteam.match_rate(auth, events).first()
    assert tuple(rate) == (4, 2, 50.0)


def test_raw_match_is_exact_and_keeps_case(auth, attacks):
    check_matching(auth, attacks)


def test_the_same_without_broadcast(auth, attacks, no_broadcast):
    check_matching(auth, attacks)


def check_preservation(auth, attacks):
    found = redteam.preservation(clean.clean_auth(auth), attacks, 7)
    counts = sorted((r.time, r.processed_match_count, r.preserved) for r in found.collect())
    assert counts == [(10, 3, 1), (10, 3, 1), (11, 1, 1), (12, 0, 0), (99, 0, 0)]
    assert tuple(redteam.preservation_summary(found).first()) == (5, 3, 60.0, False)


def test_clean_match_ignores_case_and_padding(auth, attacks):
    check_preservation(auth, attacks)


def test_clean_match_without_broadcast(auth, attacks, no_broadcast):
    check_preservation(auth, attacks)


def test_no_attack_in_the_window_fails(auth, attacks):
    found = redteam.preservation(clean.clean_auth(auth), attacks.filter("time > 86400"), 1)
    assert tuple(redteam.preservation_summary(found).first()) == (0, 0, 0.0, False)


def test_first_events(attacks):
    first = redteam.first_events(attacks, 3).orderBy("redteam_id").collect()
    assert [(r.redteam_id, r.time) for r in first] == [(1, 10), (2, 10), (3, 11)]


def test_events_of_several_files_keep_file_order(spark):
    rows = [("b", 1, 5, "b1"), ("a", 2, 9, "a2"), ("b", 2, 1, "b2"), ("a", 1, 9, "a1")]
    log = spark.createDataFrame(
        [(f, n, t, u, "C1", "C2") for f, n, t, u in rows],
        "file string, source_row long, time long, user string, src_computer string, dst_computer string")
    numbered = redteam.number_events(log).orderBy("redteam_id").collect()
    assert [r.user for r in numbered] == ["a1", "a2", "b1", "b2"]
    assert [r.user for r in redteam.first_events(log, 3).orderBy("redteam_id").collect()] == ["a1", "a2", "b1"]


def test_labels_do_not_repeat_rows(auth, attacks):
    rows = graph.label_rows(clean.clean_auth(auth), attacks).collect()
    assert sorted((r.time, r.label) for r in rows) == [(10, 1), (10, 1), (10, 1), (11, 1)]


@pytest.mark.parametrize("small", [True, False])
def test_hot_key_against_brute_force(spark, small, monkeypatch, request):
    """A third of the log and of the attacks share one key."""
    if not small:
        request.getfixturevalue("no_broadcast")
    random.seed(8)

    def key(i):
        return (5, "U0", "C0", "C1") if i % 3 == 0 else (i % 40, f"U{i % 7}", "C0", f"C{i % 5}")

    log = [key(i) for i in range(3_000)]
    attacks = [key(random.randrange(10_000)) for _ in range(300)]
    auth = spark.createDataFrame(
        [(t, u, u, s, d, None, None, None, None) for t, u, s, d in log], AUTH_SCHEMA
    ).repartition(6)
    events = redteam.number_events(spark.createDataFrame(attacks, REDTEAM_SCHEMA))
    counted = redteam.matches_per_event(auth, events).collect()
    assert len(counted) == 300
    for row in counted:
        assert row.matches == log.count((row.time, row.user, row.src_computer, row.dst_computer))
    rows = redteam.raw_matches(auth, events).groupBy("redteam_id").agg(F.count("*").alias("n")).collect()
    assert {r.redteam_id: r.n for r in rows} == {r.redteam_id: r.matches for r in counted if r.matches}
