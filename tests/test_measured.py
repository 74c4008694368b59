import pytest
from pyspark.sql import functions as F

from authweave.operators import clean, quality
from authweave.plans import adapters
from authweave.sinks import measured
from authweave.sources import tables

FOLDER, DAYS = "/root/testdata/sf0.001", 30


@pytest.fixture
def rows(spark):
    return clean.clean_auth(adapters.auth_log(spark, FOLDER))


def check(spark, path, kept):
    table = tables.read_clean_table(spark, path)
    merged = quality.merged_measures(measured.read_measures(spark, kept))
    full = quality.integrity_report(table, DAYS)
    assert merged.columns == full.columns and merged.first() == full.first()
    assert merged.schema.simpleString() == full.schema.simpleString()
    days = {r.day_index: r.processed_rows for r in measured.read_measures(spark, kept).collect()}
    assert days == {r.day_index: r["count"] for r in table.groupBy("day_index").count().collect()}


def test_measures_follow_replacements(spark, rows, tmp_path):
    path, kept = str(tmp_path / "table"), str(tmp_path / "measures")
    faulty = rows.withColumn("is_logon", F.when(F.col("time") % 7 == 0, F.lit(None)).otherwise(F.col("is_logon")))
    measured.write_table(faulty.withColumn("day_index", F.expr(adapters.WRONG_DAY).cast("int")), path, kept, DAYS)
    check(spark, path, kept)  # wrong days and rows without one
    measured.replace_days(rows, path, kept, [0, 1, 5], DAYS)
    check(spark, path, kept)
    measured.replace_days(rows.filter("day_index <> 2"), path, kept, [1, 2], DAYS)  # day 2 becomes empty
    check(spark, path, kept)
    assert 2 not in {r.day_index for r in measured.read_measures(spark, kept).collect()}
    measured.replace_days(rows, path, kept, [2, 90], DAYS)  # and comes back; day 90 never had rows
    check(spark, path, kept)


def test_only_replaced_days_are_read(spark, rows, tmp_path):
    path, kept = str(tmp_path / "table"), str(tmp_path / "measures")
    measured.write_table(rows, path, kept, DAYS)
    for file in (tmp_path / "table" / "day_index=9").glob("*.parquet"):
        file.write_bytes(b"unreadable")  # any read of another day would fail
    for file in (tmp_path / "table" / "day_index=9").glob(".*.crc"):
        file.unlink()
    before = measured.read_measures(spark, kept).filter("day_index = 9").first()
    measured.replace_days(rows, path, kept, [4], DAYS)
    assert measured.read_measures(spark, kept).filter("day_index = 9").first() == before


def test_a_call_that_failed_is_repeated(spark, rows, tmp_path, monkeypatch):
    path, kept = str(tmp_path / "table"), str(tmp_path / "measures")
    measured.write_table(rows, path, kept, DAYS)
    failures = rows.filter("is_failure = 1")
    with monkeypatch.context() as patch:
        patch.setattr(measured, "daily_measures", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            measured.replace_days(failures, path, kept, [3], DAYS)
    measured.replace_days(failures, path, kept, [3], DAYS)
    check(spark, path, kept)
