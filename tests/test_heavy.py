import pytest

from authweave.operators import heavy, profile


def both(spark, expression, rows, count):
    log = spark.range(0, rows, 1, 4).selectExpr(f"{expression} AS name")
    found, proved = heavy.heavy_hitters(log, "name", count)
    expected = profile.most_frequent(log, "name", count)
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in expected.collect()]
    assert found.schema.simpleString() == expected.schema.simpleString()
    return proved


def test_skewed_values_are_proved(spark):
    """A third of the rows on one value, a few frequent ones, 200,000 rare ones."""
    skew = "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN concat('f', pmod(xxhash64(id), 20)) ELSE concat('r', id) END"
    assert both(spark, skew, 600_000, 10)


def test_flat_values_fall_back(spark):
    assert not both(spark, "concat('v', id % 40000)", 400_000, 10)


def test_few_values_are_all_counted(spark):
    assert both(spark, "concat('v', id % 4)", 10_000, 10)
    assert both(spark, "CASE WHEN id % 4 = 0 THEN NULL ELSE concat('v', id % 30) END", 9_000, 10)


@pytest.mark.parametrize("expression", ["CAST(NULL AS STRING)", "'one'", "''"])
def test_one_value_or_none(spark, expression):
    assert both(spark, expression, 500, 3)


def test_ties_at_the_cut(spark):
    """The last wanted value occurs as often as others that the sketch holds exactly."""
    both(spark, "CASE WHEN id < 3000 THEN concat('a', id % 3) ELSE concat('b', id % 500) END", 53_000, 6)


def test_empty_log(spark):
    assert both(spark, "'x'", 0, 5)
