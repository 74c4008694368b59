"""End-to-end runs over files: inspect, cross-validate, stage, clean, validate.

Each reads paths, applies the operators and writes its tables and one JSON report.
"""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from authweave.functions.clock import day_index
from authweave.operators import clean, context, profile, quality, redteam, staging
from authweave.plans import reports
from authweave.schemas import AUTH_SCHEMA, PROCESS_SCHEMA, REDTEAM_KEY, SECONDS_PER_DAY
from authweave.sinks import writers
from authweave.sources import lines, raw_logs, tables
from authweave.workspace import pinned

DAYS = 7
SAMPLE_ROWS = 10_000
REDTEAM_SAMPLE_ROWS = 20


def _inspect(log, columns, report_of, dataset, sample_path, report_path, rows, overwrite):
    log = log.select(*columns)
    sample = pinned(profile.first_rows(log, rows or SAMPLE_ROWS, columns[1:]))
    writers.write_sample_csv(sample, sample_path, SAMPLE_ROWS, columns, overwrite)
    report = report_of(log if rows is None else sample, dataset)
    writers.write_report(report, report_path, overwrite)
    return report


def inspect_auth(
    spark: SparkSession, path: str, sample_path: str, report_path: str,
    rows: int | None = profile.SAMPLE_ROWS, overwrite: bool = False,
) -> DataFrame:
    """Profile of the first `rows` rows of the authentication log, or of all with None."""
    log = raw_logs.read_auth_log(spark, path)
    return _inspect(
        log, AUTH_SCHEMA.fieldNames(), reports.auth_summary, path,
        sample_path, report_path, rows, overwrite,
    )


def inspect_process(
    spark: SparkSession, path: str, sample_path: str, report_path: str,
    rows: int | None = profile.SAMPLE_ROWS, overwrite: bool = False,
) -> DataFrame:
    log = raw_logs.read_process_log(spark, path)
    return _inspect(
        log, PROCESS_SCHEMA.fieldNames(), reports.process_summary, path,
        sample_path, report_path, rows, overwrite,
    )


def inspect_redteam(
    spark: SparkSession, path: str, sample_path: str, report_path: str, overwrite: bool = False
) -> DataFrame:
    read = pinned(lines.read_redteam_lines(spark, path))
    first = lines.valid_lines(read).orderBy("file", "source_row").limit(REDTEAM_SAMPLE_ROWS)
    writers.write_sample_csv(
        first.select(*REDTEAM_KEY), sample_path, REDTEAM_SAMPLE_ROWS, REDTEAM_KEY, overwrite
    )
    report = reports.redteam_summary(read, path)
    writers.write_report(report, report_path, overwrite)
    return report


def _redteam_events(spark: SparkSession, path: str) -> DataFrame:
    timed = lines.valid_lines(lines.read_redteam_lines(spark, path))
    return timed.filter(F.col("time").isNotNull())


def cross_validate(
    spark: SparkSession, redteam_path: str, auth_path: str, process_path: str,
    matches_path: str, context_path: str, report_path: str,
    first: int = redteam.FIRST_EVENTS, overwrite: bool = False,
) -> DataFrame:
    """The first attacks against the raw authentication and process logs."""
    events = pinned(redteam.first_events(_redteam_events(spark, redteam_path), first))
    auth = raw_logs.well_formed(raw_logs.read_auth_log(spark, auth_path))
    process = raw_logs.well_formed(raw_logs.read_process_log(spark, process_path))

    writers.write_table_csv(
        redteam.raw_matches(auth, events).orderBy("redteam_id"), matches_path, overwrite
    )
    near = pinned(context.process_context(events, process))
    writers.write_table_csv(near.orderBy("redteam_id", "process_time"), context_path, overwrite)

    counted = pinned(redteam.matches_per_event(auth, events))
    report = reports.cross_dataset_summary(
        redteam.match_summary(counted), counted.filter(F.col("matches") == 0),
        pinned(staging.scan_counts(auth, process, events)),
        near.agg(
            F.count("*").alias("process_context_events_found"),
            F.count_if("same_user_as_redteam").alias("same_user_process_context_events"),
        ),
    )
    writers.write_report(report, report_path, overwrite)
    return report


def stage_auth(
    spark: SparkSession, auth_path: str, staged_path: str, report_path: str,
    days: int = DAYS, overwrite: bool = False,
) -> DataFrame:
    """Raw log into one folder per day, rows unchanged, with a report."""
    log = raw_logs.read_auth_log(spark, auth_path)
    bad = raw_logs.is_malformed(log)
    inside = ~bad & (F.col("time") < days * SECONDS_PER_DAY)
    day = F.when(inside, day_index(F.col("time")))
    seen = Observation("staged rows")  # filled by the write: the log is parsed once
    counted = log.observe(
        seen,
        F.count_if(inside).alias("total_valid_rows"), F.count_if(bad).alias("malformed_rows"),
        F.min(F.when(inside, F.col("time"))).alias("minimum_timestamp"),
        F.max(F.when(inside, F.col("time"))).alias("maximum_timestamp"),
        *[F.count_if(day == number).alias(f"day_{number}") for number in range(days)],
    )
    writers.write_staged_days(staging.staged_rows(counted, days), staged_path, overwrite)
    found = seen.get
    totals = spark.range(1).select(
        F.lit(days).alias("number_of_days"),
        F.lit(days * SECONDS_PER_DAY).alias("cutoff_seconds"),
        *[F.lit(found[name]).cast("long").alias(name) for name in (
            "total_valid_rows", "malformed_rows", "minimum_timestamp", "maximum_timestamp")],
    )
    day_rows = spark.createDataFrame(
        [(number, found[f"day_{number}"]) for number in range(days)], "day_index int, rows long"
    )
    report = reports.staging_summary(
        totals, day_rows, days, auth_path, staged_path
    )
    writers.write_report(report, report_path, overwrite)
    return report


def clean_staged_days(
    spark: SparkSession, staged_path: str, table_path: str, report_path: str,
    days: int = DAYS, overwrite: bool = False,
) -> DataFrame:
    """All staged days in one job into the clean table; fails early when a day is absent."""
    tables.require_days(tables.list_day_files(spark, staged_path, "*.csv.gz"), days)
    staged = raw_logs.well_formed(raw_logs.read_auth_log(spark, staged_path))
    wanted = F.coalesce(F.col("day_index").between(0, days - 1), F.lit(False))
    seen = Observation("staged rows")
    chosen = staged.observe(seen, F.count_if(~wanted).alias("outside")).filter(wanted).drop("day_index")
    writers.write_clean_table(clean.clean_auth(chosen), table_path, overwrite)
    sizes = tables.size_per_day(tables.list_day_files(spark, table_path))
    report = reports.preprocessing_summary(
        sizes, days, staged_path, table_path, seen.get["outside"]
    )
    writers.write_report(report, report_path, overwrite)
    return report


def replace_cleaned_days(
    spark: SparkSession, staged_path: str, table_path: str, chosen: list[int]
) -> None:
    """Cleans the chosen staged days again and puts them in place of what the table has."""
    staged = raw_logs.well_formed(raw_logs.read_auth_log(spark, staged_path))
    rows = staged.filter(F.col("day_index").isin(chosen)).drop("day_index")
    writers.replace_days(clean.clean_auth(rows), table_path, chosen)


def validate_table(
    spark: SparkSession, table_path: str, redteam_path: str, staging_report: str | None,
    matches_path: str, report_path: str, days: int = DAYS, overwrite: bool = False,
) -> DataFrame:
    """The nine checks over the clean table, the attack table as CSV, and the report.

    The whole table is checked: rows without a day or of days outside the window fail it.
    """
    files = pinned(tables.list_day_files(spark, table_path))
    tables.require_days(files, days)
    table = tables.read_clean_table(spark, table_path)
    staged = tables.read_report(spark, staging_report) if staging_report else None

    found = pinned(redteam.preservation(table, _redteam_events(spark, redteam_path), days))
    writers.write_table_csv(found.drop("file").orderBy("event_id"), matches_path, overwrite)

    summary = redteam.preservation_summary(found)
    measured = pinned(quality.measure(table, files, summary, staged, days))
    clean_days = pinned(staging.rows_per_day(table.filter("day_index IS NOT NULL")))
    staged_days = tables.reported_days(staged) if staged is not None else clean_days.limit(0)
    total = staged if staged is not None else spark.range(1).select(
        F.lit(None).cast("bigint").alias("total_valid_rows")
    )
    report = reports.validation_summary(
        table, measured, tables.size_per_day(files),
        staging.retention(total, measured.select("processed_rows")),
        staging.daily_retention(staged_days, clean_days, days),
        summary, days, table_path, matches_path, staged is not None,
    )
    writers.write_report(report, report_path, overwrite)
    return report
