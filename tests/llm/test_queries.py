import comparing
import pytest

import __spark_entry__
from authweave.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = set(queries.queries())
    assert {n.split("_")[0] for n in names} == {f"op{k}" for k in range(1, 14)}
    assert names | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(queries.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    duck = comparing.connect(FOLDER)
    assert comparing.differences(queries.queries()[name](spark, FOLDER), duck, queries.oracle_sql()[name]) == ""
