"""Profiles of the raw logs: missing values, distinct entities, frequencies, extremes."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS = 50_000


def missing_values(log: DataFrame, names: list[str]) -> DataFrame:
    """One row: null count of each column."""
    return log.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in names])


def distinct_value_columns(names: list[str], null_counts: bool) -> dict[str, Column]:
    """Distinct-count expression per column; null is one more value when `null_counts`."""
    known = {name: F.count_distinct(F.col(name)) for name in names}
    if not null_counts:
        return known
    return {
        name: count + F.coalesce(F.max(F.col(name).isNull().cast("long")), F.lit(0))
        for name, count in known.items()
    }


def distinct_values(log: DataFrame, names: list[str], null_counts: bool) -> DataFrame:
    """One row: distinct values per column."""
    counts = distinct_value_columns(names, null_counts)
    return log.agg(*[count.alias(f"unique_{name}") for name, count in counts.items()])


def frequencies(log: DataFrame, name: str) -> DataFrame:
    """Rows per value, null included, most frequent first."""
    return (
        log.groupBy(name).agg(F.count("*").alias("rows"))
        .orderBy(F.desc("rows"), F.asc_nulls_last(name))
    )


def most_frequent(log: DataFrame, name: str, count: int) -> DataFrame:
    return frequencies(log, name).limit(count)


def time_range(log: DataFrame) -> DataFrame:
    return log.agg(
        F.min("time").alias("minimum_timestamp"), F.max("time").alias("maximum_timestamp")
    )


def first_rows(log: DataFrame, count: int, order: list[str]) -> DataFrame:
    """The first rows by time, then by the other columns; rows without a time come last.

    With many rows asked for, each task would hand its own first `count` to the last
    sort. So the second in which the last wanted row lies is found from row counts per
    second, and later rows are filtered out at the scan: the bound is fetched first and so a
    literal. The sums over seconds run in one task, over `count` rows at most.
    """
    seconds = log.filter(F.col("time").isNotNull()).groupBy("time").agg(F.count("*").alias("rows"))
    candidates = seconds.orderBy("time").limit(count)
    so_far = Window.orderBy("time").rowsBetween(Window.unboundedPreceding, -1)
    needed = candidates.withColumn("before", F.coalesce(F.sum("rows").over(so_far), F.lit(0)))
    bounds = needed.filter(F.col("before") < count).agg(
        F.max("time").alias("last"), F.sum("rows").alias("rows")
    )
    found = bounds.first()
    # with fewer timed rows than wanted, rows without a time fill up the rest
    enough = found.rows is not None and found.rows >= count
    near = log.filter(F.col("time") <= found.last) if enough else log
    return near.orderBy(F.asc_nulls_last("time"), *[F.asc_nulls_last(name) for name in order]).limit(count)
