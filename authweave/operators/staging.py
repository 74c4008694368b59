"""Counts over the raw log before cleaning, and row reconciliation afterwards."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authweave.functions.clock import day_index
from authweave.operators.clean import before_day
from authweave.schemas import CONTEXT_WINDOW_SECONDS, SECONDS_PER_DAY
from authweave.sources.raw_logs import is_malformed, well_formed
from authweave.sources.tables import expected_days


def staged_rows(log: DataFrame, days: int) -> DataFrame:
    """Well-formed rows of the first `days` days with their day."""
    rows = before_day(well_formed(log), days)
    return rows.withColumn("day_index", day_index(F.col("time")))


def staging_counts(log: DataFrame, days: int) -> DataFrame:
    """One row: valid rows inside the window and malformed rows of the whole log."""
    bad = is_malformed(log)
    inside = ~bad & (F.col("time") < days * SECONDS_PER_DAY)
    return log.agg(
        F.count_if(inside).alias("total_valid_rows"),
        F.count_if(bad).alias("malformed_rows"),
    )


def rows_per_day(table: DataFrame) -> DataFrame:
    return table.groupBy("day_index").agg(F.count("*").alias("rows")).orderBy("day_index")


def staging_report(log: DataFrame, days: int) -> DataFrame:
    """One row: window, valid and malformed rows, and the true time extremes."""
    bad = is_malformed(log)
    inside = ~bad & (F.col("time") < days * SECONDS_PER_DAY)
    kept_time = F.when(inside, F.col("time"))
    return log.agg(
        F.lit(days).alias("number_of_days"),
        F.lit(days * SECONDS_PER_DAY).cast("long").alias("cutoff_seconds"),
        F.count_if(inside).alias("total_valid_rows"),
        F.count_if(bad).alias("malformed_rows"),
        F.min(kept_time).alias("minimum_timestamp"),
        F.max(kept_time).alias("maximum_timestamp"),
    )


def daily_retention(staged_days: DataFrame, clean_days: DataFrame, days: int) -> DataFrame:
    """Staged and cleaned rows of each expected day (inputs: day_index, rows)."""
    spine = expected_days(staged_days.sparkSession, days)
    staged = staged_days.select("day_index", F.col("rows").alias("staged"))
    cleaned = clean_days.select("day_index", F.col("rows").alias("cleaned"))
    both = spine.join(staged, "day_index", "left").join(cleaned, "day_index", "left")
    before = F.coalesce("staged", F.lit(0))
    after = F.coalesce("cleaned", F.lit(0))
    return both.select(
        "day_index",
        before.alias("staged_rows"),
        after.alias("processed_rows"),
        (before - after).alias("removed_rows"),
        F.round(F.try_divide(after, before) * 100, 6).alias("retention_rate_percent"),
    )


def retention(staged_total: DataFrame, processed: DataFrame) -> DataFrame:
    """One row. Inputs are one-row tables with `total_valid_rows` and `processed_rows`."""
    staged = staged_total.select("total_valid_rows").scalar()
    return processed.withColumn("staged_rows", staged).select(
        "staged_rows",
        "processed_rows",
        (F.col("staged_rows") - F.col("processed_rows")).alias("removed_rows"),
        F.round(F.try_divide(F.col("processed_rows"), F.col("staged_rows")) * 100, 6)
        .alias("retention_rate_percent"),
    )


def _read_until(log: DataFrame, limit: DataFrame) -> DataFrame:
    """Rows a time-ordered reader sees: up to the limit, plus the row that ends it."""
    last = limit.scalar()
    return well_formed(log).select("time").agg(
        (F.count_if(F.col("time") <= last)
         + F.coalesce(F.max((F.col("time") > last).cast("int")), F.lit(0))).alias("rows")
    )


def scan_counts(auth: DataFrame, process: DataFrame, events: DataFrame) -> DataFrame:
    """One row: rows read from each log until the last event (plus window) has passed."""
    last = events.agg(F.max("time").alias("last"))
    last_context = events.agg((F.max("time") + CONTEXT_WINDOW_SECONDS).alias("last"))
    return _read_until(auth, last).select(
        F.col("rows").alias("auth_rows_scanned"),
        _read_until(process, last_context).scalar().alias("process_rows_scanned"),
    )
