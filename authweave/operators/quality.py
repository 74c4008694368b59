"""Quality checks of the clean table."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authweave.functions.clock import floor_div
from authweave.schemas import CLEAN_SCHEMA, CRITICAL_COLUMNS, FLAG_COLUMNS, SECONDS_PER_DAY
from authweave.sources.tables import missing_days

# Names of ranges, contradictions and checks in the report format.
RANGE_COLUMNS = ["time", "day_index", "second_of_day", "hour"]
CONTRADICTIONS = [
    "invalid_host_relationship", "failure_flag_mismatch_1",
    "failure_flag_mismatch_2", "simultaneous_logon_logoff", "day_time_mismatch",
]
CHECKS = [
    "physical_output", "schema", "day_coverage", "row_integrity", "critical_nulls",
    "binary_fields", "temporal_ranges", "logical_consistency", "redteam_preservation",
]


def _outside(name: str, low: int, high: int) -> Column:
    return (F.col(name) < low) | (F.col(name) > high)


def _not_in(name: str, values: list[int]) -> Column:
    return F.col(name).isNull() | ~F.col(name).isin(values)


def _measures(days: int) -> list[Column]:
    extremes = [
        pick(name).alias(f"{label}_{name}")
        for name in RANGE_COLUMNS
        for pick, label in ((F.min, "minimum"), (F.max, "maximum"))
    ]
    outcome = F.col("success_flag")
    faults = {
        **{f"null_{name}": F.col(name).isNull() for name in CRITICAL_COLUMNS},
        **{f"invalid_{name}": _not_in(name, [0, 1]) for name in FLAG_COLUMNS},
        "invalid_success_flag": _not_in("success_flag", [-1, 0, 1]),
        "invalid_day_index": _outside("day_index", 0, days - 1),
        "invalid_second_of_day": _outside("second_of_day", 0, SECONDS_PER_DAY - 1),
        "invalid_hour": _outside("hour", 0, 23),
        "invalid_host_relationship": F.col("same_computer") + F.col("cross_host") != 1,
        "failure_flag_mismatch_1": (outcome == 0) & (F.col("is_failure") != 1),
        "failure_flag_mismatch_2": (outcome != 0) & (F.col("is_failure") != 0),
        "simultaneous_logon_logoff": (F.col("is_logon") == 1) & (F.col("is_logoff") == 1),
        "day_time_mismatch": F.col("day_index") != floor_div(F.col("time"), SECONDS_PER_DAY),
    }
    counts = [F.count_if(fault).alias(name) for name, fault in faults.items()]
    return [F.count("*").alias("processed_rows"), *extremes, *counts]


def integrity_report(clean: DataFrame, days: int) -> DataFrame:
    """33 measures of the whole table in one pass, one row. Rows outside the days count too."""
    return clean.agg(*_measures(days))


def daily_measures(clean: DataFrame, days: int) -> DataFrame:
    """The same measures for each day_index, null included: a row per day, to be kept and merged."""
    return clean.groupBy("day_index").agg(*_measures(days))


def merged_measures(daily: DataFrame) -> DataFrame:
    """One row: the measures of all days together, as `integrity_report` finds them in the rows."""
    merge = {"minimum": F.min, "maximum": F.max}
    names = [name for name in daily.columns if name != "day_index"]
    return daily.agg(*[
        merge[kind](name).alias(name) if (kind := name.split("_")[0]) in merge
        else F.coalesce(F.sum(name), F.lit(0).cast("long")).alias(name)
        for name in names
    ])


def schema_report(table: DataFrame) -> DataFrame:
    """Every expected or present column: types, verdict and number of non-null values."""
    actual = {field.name: field.dataType.simpleString() for field in table.schema}
    expected = {field.name: field.dataType.simpleString() for field in CLEAN_SCHEMA}

    def verdict(name: str) -> str:
        if name not in actual:
            return "missing"
        if name not in expected:
            return "unexpected"
        return "ok" if actual[name] == expected[name] else "type_mismatch"

    def line(name: str) -> Column:
        return F.struct(
            F.lit(name).alias("column"),
            F.lit(expected.get(name)).cast("string").alias("expected"),
            F.lit(actual.get(name)).cast("string").alias("actual"),
            F.lit(verdict(name)).alias("status"),
            (F.count(F.col(name)) if name in actual else F.lit(0)).cast("long").alias("values"),
        )

    lines = [line(name) for name in {**expected, **actual}]
    return table.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def schema_diff(table: DataFrame) -> DataFrame:
    """Columns that are missing, unexpected or of another type; empty when all is well."""
    return schema_report(table).filter(F.col("status") != "ok").drop("values")


def schema_matches(table: DataFrame) -> bool:
    """Names and types as expected, whatever the column order. No job."""
    def typed(schema):
        return {(field.name, field.dataType.simpleString()) for field in schema}
    return typed(table.schema) == typed(CLEAN_SCHEMA)


def _all_zero(names: list[str]) -> Column:
    return reduce(and_, [F.col(name) == 0 for name in names])


def measure(
    clean: DataFrame, files: DataFrame, redteam_summary: DataFrame,
    staged_total: DataFrame | None, days: int,
) -> DataFrame:
    """One row: the integrity measures, the present days, one boolean per check, and `overall`.

    One pass over the whole table: rows without a day or outside the days are what some of
    the checks look for, so the table must not be filtered by day. The set of days is small.
    `files` is the listing of the table's data files, `staged_total` one row with
    `total_valid_rows` or None when nothing is known about staging.
    """
    present = F.sort_array(F.collect_set("day_index")).alias("present_days")
    return _judged(clean.agg(*_measures(days), present), clean, files, redteam_summary, staged_total, days)


def measure_from_days(
    daily: DataFrame, clean: DataFrame, files: DataFrame, redteam_summary: DataFrame,
    staged_total: DataFrame | None, days: int,
) -> DataFrame:
    """The row of `measure` from kept measures per day; of the table only the schema is looked at."""
    present = daily.agg(F.sort_array(F.collect_set("day_index")).alias("present_days")).scalar()
    measured = merged_measures(daily).withColumn("present_days", present)
    return _judged(measured, clean, files, redteam_summary, staged_total, days)


def _judged(
    measured: DataFrame, clean: DataFrame, files: DataFrame, redteam_summary: DataFrame,
    staged_total: DataFrame | None, days: int,
) -> DataFrame:
    absent = missing_days(files, days).agg(F.count("*").alias("days")).scalar()
    kept = F.col("processed_rows") > 0
    if staged_total is not None:
        kept = kept & (F.col("processed_rows") <= staged_total.select("total_valid_rows").scalar())
    verdicts = {
        "physical_output": absent == 0,
        "schema": F.lit(schema_matches(clean)),
        "day_coverage": F.coalesce(
            (F.size("present_days") == days)
            & (F.col("minimum_day_index") == 0) & (F.col("maximum_day_index") == days - 1),
            F.lit(False),
        ),
        "row_integrity": kept,
        "critical_nulls": _all_zero([f"null_{name}" for name in CRITICAL_COLUMNS]),
        "binary_fields": _all_zero(
            [f"invalid_{name}" for name in [*FLAG_COLUMNS, "success_flag"]]
        ),
        "temporal_ranges": _all_zero(
            ["invalid_day_index", "invalid_second_of_day", "invalid_hour"]
        ),
        "logical_consistency": _all_zero(CONTRADICTIONS),
        "redteam_preservation": redteam_summary.select("pass").scalar(),
    }
    return measured.withColumns(verdicts).withColumn("overall", reduce(and_, [F.col(name) for name in CHECKS]))


def validation_checks(measured: DataFrame) -> DataFrame:
    """The nine checks and the overall verdict of a `measure` row, one row each."""
    names = [*CHECKS, "overall"]
    return measured.select(*names).unpivot([], names, "check", "passed")
