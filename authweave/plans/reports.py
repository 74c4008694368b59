"""One-row reports of the jobs; written as JSON they have one object per run.

The field names are fixed: they are the format in which the results are exchanged.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authweave.operators import profile, quality
from authweave.operators.quality import CHECKS, CONTRADICTIONS, RANGE_COLUMNS
from authweave.schemas import (
    AUTH_SCHEMA, CLEAN_COLUMNS, CLEAN_SCHEMA, CONTEXT_WINDOW_SECONDS,
    CRITICAL_COLUMNS, FLAG_COLUMNS, PROCESS_SCHEMA, REDTEAM_KEY,
)
from authweave.sources.tables import expected_days


def _names(names: list[str]) -> Column:
    return F.array(*map(F.lit, names)) if names else F.lit([]).cast("array<string>")


def _counts(names: list[str], prefix: str) -> Column:
    return F.struct(*[F.col(f"{prefix}{name}").alias(name) for name in names])


def by_day(table: DataFrame, value: Column, days: int) -> DataFrame:
    """One row, one map: day number as text to `value`; expected days only."""
    spine = expected_days(table.sparkSession, days)
    pairs = spine.join(table, "day_index", "left").select("day_index", value.alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("day_index", "value")))
    named = F.transform(
        ordered, lambda pair: F.struct(pair.day_index.cast("string"), pair.value)
    )
    return pairs.agg(F.map_from_entries(named).alias("by_day"))


def staging_summary(
    report: DataFrame, day_rows: DataFrame, days: int, dataset: str, output: str
) -> DataFrame:
    rows = by_day(day_rows, F.coalesce("rows", F.lit(0)), days).scalar()
    return report.select(
        F.lit(dataset).alias("source_dataset"), *report.columns,
        rows.alias("rows_per_day"), F.lit(output).alias("output_directory"),
    )


def preprocessing_summary(
    sizes: DataFrame, days: int, source: str, output: str, outside: int
) -> DataFrame:
    """`outside`: staged rows of other days, which are not in the table."""
    day = F.struct(
        F.col("day_index").alias("day"),
        F.concat(F.lit(f"{source}/day_index="), "day_index").alias("input_file"),
        F.concat(F.lit(f"{output}/day_index="), "day_index").alias("output_directory"),
        F.col("size_mb").alias("output_size_mb"),
    )
    generated = [name for name in CLEAN_COLUMNS if name not in AUTH_SCHEMA.fieldNames()]
    spine = expected_days(sizes.sparkSession, days)
    return spine.join(sizes, "day_index", "left").agg(
        F.lit("authentication cleaning").alias("phase"),
        F.lit(days).alias("days_processed"),
        F.lit(source).alias("input_directory"),
        F.lit(output).alias("output_directory"),
        F.lit("Parquet").alias("output_format"),
        F.lit("Snappy").alias("compression"),
        F.lit(outside).cast("long").alias("rows_outside_days"),
        _names(generated).alias("generated_columns"),
        F.array_sort(F.collect_list(day)).alias("processed_days"),
    )


def _schema_section(table: DataFrame) -> Column:
    def typed(schema):
        return F.struct(*[F.lit(f.dataType.simpleString()).alias(f.name) for f in schema])
    actual = {field.name: field.dataType.simpleString() for field in table.schema}
    expected = {field.name: field.dataType.simpleString() for field in CLEAN_SCHEMA}
    wrong = {name for name in expected if actual.get(name, expected[name]) != expected[name]}
    mismatches = F.to_json(F.create_map(*[
        item
        for name in sorted(wrong)
        for item in (F.lit(name), F.struct(
            F.lit(expected[name]).alias("expected"), F.lit(actual[name]).alias("actual")))
    ])) if wrong else F.lit("{}")
    return F.struct(
        typed(CLEAN_SCHEMA).alias("expected"),
        typed(table.schema).alias("actual"),
        _names([name for name in expected if name not in actual]).alias("missing_columns"),
        _names([name for name in actual if name not in expected]).alias("unexpected_columns"),
        F.from_json(mismatches, "map<string, struct<expected: string, actual: string>>")
        .alias("type_mismatches"),
        F.lit(quality.schema_matches(table)).alias("pass"),
    )


def validation_summary(
    table: DataFrame, measured: DataFrame, sizes: DataFrame, retained: DataFrame,
    retained_days: DataFrame, preserved: DataFrame, days: int, source: str, details: str,
    staged: bool,
) -> DataFrame:
    """The quality report. `measured`, `retained`, `preserved` are one-row tables.

    Without a staging report (`staged` false) there is no retention per day.
    """
    day_value = F.struct("staged_rows", "processed_rows", "removed_rows", "retention_rate_percent")
    totals = {name: retained.select(name).scalar() for name in retained.columns}
    found = {name: preserved.select(name).scalar() for name in preserved.columns}
    processed = by_day(retained_days, F.coalesce("processed_rows", F.lit(0)), days)
    ranges = [f"{edge}_{name}" for name in RANGE_COLUMNS for edge in ("minimum", "maximum")]
    return measured.select(
        F.lit("clean table validation").alias("phase"),
        F.when(F.col("overall"), "PASS").otherwise("FAIL").alias("validation_status"),
        F.lit(source).alias("input_directory"),
        F.lit(days).alias("days_validated"),
        by_day(sizes, F.col("size_mb"), days).scalar().alias("output_sizes_mb"),
        _schema_section(table).alias("schema"),
        F.struct(
            *[value.alias(name) for name, value in totals.items()],
            processed.scalar().alias("processed_rows_per_day"),
            (by_day(retained_days, day_value, days).scalar() if staged else F.create_map())
            .alias("daily_retention"),
            F.col("row_integrity").alias("pass"),
        ).alias("row_integrity"),
        F.struct(*ranges).alias("ranges"),
        _counts(CRITICAL_COLUMNS, "null_").alias("critical_null_counts"),
        _counts(FLAG_COLUMNS, "invalid_").alias("invalid_binary_counts"),
        "invalid_success_flag",
        _counts(["day_index", "second_of_day", "hour"], "invalid_").alias("invalid_temporal_counts"),
        F.struct(*CONTRADICTIONS).alias("logical_consistency_counts"),
        F.struct(
            F.sequence(F.lit(0), F.lit(days - 1)).alias("expected_days"),
            "present_days",
            F.col("day_coverage").alias("pass"),
        ).alias("day_coverage"),
        F.struct(
            *[value.alias(name) for name, value in found.items()],
            F.lit(details).alias("details_csv"),
        ).alias("redteam_preservation"),
        F.struct(*CHECKS).alias("checks"),
    )


def cross_dataset_summary(
    rate: DataFrame, unmatched: DataFrame, scans: DataFrame, near: DataFrame
) -> DataFrame:
    """Inputs are one-row tables except `unmatched`, the few tested events without a match."""
    ids = unmatched.agg(F.array_sort(F.collect_list("redteam_id")).alias("ids"))
    return rate.select(
        F.lit("cross-dataset validation").alias("phase"), *rate.columns,
        ids.scalar().alias("unmatched_redteam_ids"),
        *[scans.select(name).scalar().alias(name) for name in scans.columns],
        near.select("process_context_events_found").scalar().alias("process_context_events_found"),
        near.select("same_user_process_context_events").scalar()
        .alias("same_user_process_context_events"),
        F.lit(CONTEXT_WINDOW_SECONDS).alias("process_context_window_seconds"),
    )


def log_summary(
    sample: DataFrame, dataset: str, columns: list[str], entities: dict[str, str]
) -> DataFrame:
    """Profile of a log: rows, distinct values of `entities` (column to label), extremes,
    and missing values, all in one pass."""
    counts = profile.distinct_value_columns(list(entities), True)
    one_pass = sample.agg(
        F.count("*").alias("inspection_rows"),
        *[count.alias(f"unique_{entities[name]}_in_sample") for name, count in counts.items()],
        F.min("time").alias("minimum_timestamp"),
        F.max("time").alias("maximum_timestamp"),
        F.struct(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
        .alias("missing_values_in_sample"),
    )
    return one_pass.select(F.lit(dataset).alias("dataset"), "*", _names(columns).alias("schema"))


def auth_summary(sample: DataFrame, dataset: str) -> DataFrame:
    return log_summary(sample, dataset, AUTH_SCHEMA.fieldNames(), {
        "src_user": "source_users", "dst_user": "destination_users",
        "src_computer": "source_computers", "dst_computer": "destination_computers",
    })


def process_summary(sample: DataFrame, dataset: str) -> DataFrame:
    return log_summary(sample, dataset, PROCESS_SCHEMA.fieldNames(), {
        "user": "users", "computer": "computers", "process": "processes",
    })


def redteam_summary(lines: DataFrame, dataset: str) -> DataFrame:
    """Profile of the red-team log from its numbered lines, in one pass."""
    valid = ~F.col("wrong_fields")

    def distinct(name: str) -> Column:
        return F.count_distinct(F.when(valid, F.col(name)))

    return lines.agg(
        F.lit(dataset).alias("dataset"),
        _names(REDTEAM_KEY).alias("schema"),
        F.count_if(valid).alias("total_valid_events"),
        F.count_if(~valid).alias("malformed_rows"),
        distinct("user").alias("unique_users"),
        distinct("src_computer").alias("unique_source_computers"),
        distinct("dst_computer").alias("unique_destination_computers"),
        F.min(F.when(valid, F.col("time"))).alias("minimum_timestamp"),
        F.max(F.when(valid, F.col("time"))).alias("maximum_timestamp"),
    )
