import comparing
import pytest

import __spark_entry__
from authweave.plans import catalog, oracles

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return comparing.connect(FOLDER)


def test_entry_has_them_all():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_faults_are_found(spark):
    verdicts = {r.check: r.passed for r in QUERIES["validation_faults"](spark, FOLDER).collect()}
    failed = {"day_coverage", "critical_nulls", "temporal_ranges", "logical_consistency", "overall"}
    assert {name for name, passed in verdicts.items() if not passed} == failed


def test_attacks_without_an_edge_are_misses(spark, duck):
    row = QUERIES["evaluation"](spark, FOLDER).first()
    attacked = duck.execute(oracles._sql("red_norm", "SELECT count(*) FROM (SELECT DISTINCT user, dst_computer FROM red_norm)")).fetchone()[0]
    assert row.true_positives + row.false_negatives == attacked


def test_edges_keep_all_their_rows(spark):
    assert QUERIES["edge_index"](spark, FOLDER).count() == QUERIES["graph_edges"](spark, FOLDER).count()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"size_per_day"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    assert comparing.differences(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) == ""


def test_sizes_cover_all_days(spark):
    rows = QUERIES["size_per_day"](spark, FOLDER).collect()
    assert sorted(row.day_index for row in rows) == list(range(30))
    assert all(row.files >= 1 and row.size_mb >= 0 for row in rows)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 30
