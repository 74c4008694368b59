import random

import pytest

from authweave.operators import context
from authweave.schemas import PROCESS_SCHEMA

EVENTS = "redteam_id long, time long, user string, src_computer string, dst_computer string"


def brute(events, process):
    pairs = []
    for number, time, user, source, target in events:
        for at, who, where, what, kind in process:
            if where is not None and abs(at - time) <= 300 and where in (source, target):
                role = "source_host" if where == source else "destination_host"
                pairs.append((number, time, user, source, target, at, abs(at - time), who, where,
                              role, None if user is None or who is None else who == user, what, kind))
    return sorted(pairs, key=str)


def check(spark, events, process):
    left = spark.createDataFrame(events, EVENTS)
    right = spark.createDataFrame(process, PROCESS_SCHEMA).repartition(5)
    expected = brute(events, process)
    found = context.process_context(left, right).collect()
    assert sorted(map(tuple, found), key=str) == expected
    summary = context.context_summary(left, right).first()
    assert tuple(summary) == (len(expected), sum(1 for p in expected if p[10]), 300)
    evidence = context.process_evidence(left.withColumnRenamed("redteam_id", "alert_id"), right, ["alert_id"])
    per_alert = {
        row.alert_id: (row.process_events, row.same_user_process_events, row.distinct_processes,
                       row.first_process_time, row.last_process_time)
        for row in evidence.collect()
    }
    wanted = {}
    for number in {p[0] for p in expected}:
        mine = [p for p in expected if p[0] == number]
        wanted[number] = (len(mine), sum(1 for p in mine if p[10]), len({p[11] for p in mine}),
                          min(p[5] for p in mine), max(p[5] for p in mine))
    assert per_alert == wanted


EDGES = (
    [(1, 1_000, "U1", "C1", "C2"), (2, 1_000, "U1", "C3", "C3"), (3, -10, "U2", "C1", None)],
    [(t, u, c, "P1", "Start") for t in (699, 700, 1_000, 1_300, 1_301, -310, -311, 290, 291)
     for u, c in (("U1", "C1"), ("U2", "C2"), ("U1", "C3"), ("U1", None))],
)


def hot():
    random.seed(5)
    events = [(i, random.randrange(3_000), f"U{i % 3}", "C0" if i % 3 == 0 else f"C{i % 9}", f"C{i % 4}")
              for i in range(60)]
    process = [(random.randrange(-500, 3_500), f"U{i % 4}", "C0" if i % 3 == 0 else f"C{i % 11}",
                f"P{i % 6}", "End") for i in range(900)]
    return events, process


@pytest.mark.parametrize("events, process", [EDGES, hot()])
def test_context(spark, events, process):
    check(spark, events, process)


@pytest.mark.parametrize("events, process", [EDGES, hot()])
def test_context_without_broadcast(spark, no_broadcast, events, process):
    check(spark, events, process)


def test_evidence_of_many_contacts(spark):
    """A row near several contacts of an alert counts once; both hosts of every contact count."""
    random.seed(6)
    contacts = [(f"U{k % 2}", random.randrange(4_000), f"C{random.randrange(4)}", f"C{k % 3}") for k in range(80)]
    _, process = hot()
    left = spark.createDataFrame(contacts, "user string, time long, src_computer string, dst_computer string")
    found = context.process_evidence(left, spark.createDataFrame(process, PROCESS_SCHEMA), ["user", "dst_computer"])
    got = {(r.user, r.dst_computer): (r.process_events, r.same_user_process_events) for r in found.collect()}
    want = {}
    for key in {(u, d) for u, _, _, d in contacts}:
        near = [p for p in process if any(
            abs(p[0] - t) <= 300 and p[2] in (s, d) for u, t, s, d in contacts if (u, d) == key)]
        if near:
            want[key] = (len(near), sum(p[1] == key[0] for p in near))
    assert got == want


def test_no_events(spark):
    process = spark.createDataFrame(EDGES[1], PROCESS_SCHEMA)
    none = spark.createDataFrame([], EVENTS)
    assert context.process_context(none, process).count() == 0
    assert tuple(context.context_summary(none, process).first()) == (0, 0, 300)
