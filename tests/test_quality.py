import pytest
from pyspark.sql import functions as F

from authweave.operators import clean, quality
from authweave.schemas import AUTH_SCHEMA

DAYS = 2


@pytest.fixture(scope="module")
def table(spark):
    rows = [(t, "U1@D", "U2@D", "C1", "C2", "NTLM", "Network", "LogOn", "Success")
            for t in (10, 50_000, 90_000, 172_799)]
    rows.append((20, "U1@D", "U1@D", "C1", "C1", None, None, "LogOff", "Fail"))
    return clean.clean_auth(spark.createDataFrame(rows, AUTH_SCHEMA))


def files(spark, days=(0, 1)):
    return spark.createDataFrame([(d, f"f{d}", 1) for d in days], "day_index int, path string, length long")


def verdicts(spark, table, days=DAYS, listed=(0, 1), attacks_pass=True, staged=5):
    summary = spark.range(1).select(F.lit(attacks_pass).alias("pass"))
    total = None if staged is None else spark.range(1).select(
        F.lit(staged).cast("long").alias("total_valid_rows"))
    measured = quality.measure(table, files(spark, listed), summary, total, days)
    return {row.check: row.passed for row in quality.validation_checks(measured).collect()}


def failed(found):
    return {name for name, passed in found.items() if not passed}


def test_all_checks_pass(spark, table):
    found = verdicts(spark, table)
    assert len(found) == 10 and failed(found) == set()
    assert failed(verdicts(spark, table, staged=None)) == set()


def test_report_has_33_measures(table):
    assert len(quality.integrity_report(table, DAYS).columns) == 33


def test_empty_table_counts_zero(spark, table):
    row = quality.integrity_report(table.limit(0), DAYS).first()
    assert row.processed_rows == 0 and row.null_time == 0 and row.minimum_time is None
    assert failed(verdicts(spark, table.limit(0))) == {"row_integrity", "day_coverage", "overall"}


FAULTS = {
    "hour": ("24", {"temporal_ranges"}),
    "second_of_day": ("86400", {"temporal_ranges"}),
    "is_logon": ("2", {"binary_fields"}),
    "same_user": ("CAST(NULL AS int)", {"binary_fields"}),
    "success_flag": ("7", {"binary_fields", "logical_consistency"}),
    "is_failure": ("1", {"logical_consistency"}),
    "cross_host": ("0", {"logical_consistency"}),
    "is_logoff": ("1", {"logical_consistency"}),
    "src_user": ("CAST(NULL AS string)", {"critical_nulls"}),
    "day_index": ("5", {"temporal_ranges", "day_coverage", "logical_consistency"}),
    "time": ("1", {"schema", "logical_consistency"}),
}


@pytest.mark.parametrize("name", sorted(FAULTS))
def test_each_fault_is_found(spark, table, name):
    value, expected = FAULTS[name]
    assert failed(verdicts(spark, table.withColumn(name, F.expr(value)))) == expected | {"overall"}


def test_other_failures(spark, table):
    assert failed(verdicts(spark, table, listed=(1,))) == {"physical_output", "overall"}
    assert failed(verdicts(spark, table, staged=4)) == {"row_integrity", "overall"}
    assert failed(verdicts(spark, table, attacks_pass=False)) == {"redteam_preservation", "overall"}
    assert "day_coverage" in failed(verdicts(spark, table, days=3, listed=(0, 1, 2)))


def test_null_day_is_left_to_the_null_check(spark, table):
    lost = table.limit(1).withColumn("day_index", F.lit(None).cast("int"))
    assert failed(verdicts(spark, table.unionAll(lost), staged=6)) == {"critical_nulls", "overall"}


def test_schema_diff(table):
    assert quality.schema_diff(table).count() == 0
    wrong = table.drop("hour").withColumn("time", F.col("time").cast("int")).withColumn("extra", F.lit(1.0))
    rows = {(r.column, r.expected, r.actual, r.status) for r in quality.schema_diff(wrong).collect()}
    assert rows == {("hour", "int", None, "missing"), ("time", "bigint", "int", "type_mismatch"),
                    ("extra", None, "double", "unexpected")}
    assert not quality.schema_matches(wrong)
    assert quality.schema_matches(table.select(*reversed(table.columns)))
