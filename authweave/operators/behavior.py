"""Per-user behaviour over the clean table.

Everything starts from counts per user, host and day, so a user with a large share of
all rows shrinks to a few rows before the shuffle; windows then see at most one row
per day.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BASELINE_DAYS = 7


def _outcomes() -> list[Column]:
    return [
        F.count("*").alias("auth_count"),
        F.count_if(F.col("is_failure") == 1).alias("failed_count"),
        F.count_if(F.col("success_flag") == 1).alias("successful_count"),
        F.sum(F.col("cross_host").cast("long")).alias("cross_host_count"),
    ]


def _share(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole), 6)


def user_activity(clean: DataFrame) -> DataFrame:
    """All, failed, successful and cross-host authentications per user and day."""
    return clean.groupBy("src_user", "day_index").agg(*_outcomes())


def daily_edges(clean: DataFrame) -> DataFrame:
    """Activity per user, destination host and day."""
    return clean.groupBy("src_user", "dst_computer", "day_index").agg(
        *_outcomes(), F.min("time").alias("first_time"), F.max("time").alias("last_time")
    )


def user_host_history(edges_by_day: DataFrame) -> DataFrame:
    """Accesses per user, host and day, with all accesses on earlier days."""
    earlier = Window.partitionBy("src_user", "dst_computer").orderBy("day_index").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return edges_by_day.select(
        "src_user", "dst_computer", "day_index", "auth_count",
        F.coalesce(F.sum("auth_count").over(earlier), F.lit(0)).alias("earlier_count"),
    )


def unique_hosts(edges_by_day: DataFrame) -> DataFrame:
    """Distinct destination hosts per user and day: one row per host is left to count."""
    return edges_by_day.groupBy("src_user", "day_index").agg(
        F.count("*").alias("unique_hosts")
    )


def first_contacts(edges_by_day: DataFrame) -> DataFrame:
    """When each user reached each destination host for the first time."""
    return edges_by_day.groupBy("src_user", "dst_computer").agg(
        F.min("first_time").alias("first_time"), F.min("day_index").alias("first_day")
    )


def new_hosts(edges_by_day: DataFrame) -> DataFrame:
    """Destination hosts per user and day that the user had not reached before."""
    return first_contacts(edges_by_day).groupBy(
        "src_user", F.col("first_day").alias("day_index")
    ).agg(F.count("*").alias("new_hosts"))


def cross_host_activity(activity: DataFrame) -> DataFrame:
    return activity.select(
        "src_user", "day_index", "auth_count", "cross_host_count",
        _share(F.col("cross_host_count"), F.col("auth_count")).alias("cross_host_share"),
    )


def login_hours(clean: DataFrame) -> DataFrame:
    """Logons per user and hour, and the hour's share of the user's logons."""
    hours = clean.filter(F.col("is_logon") == 1).groupBy("src_user", "hour").agg(
        F.count("*").alias("logons")
    )
    total = F.sum("logons").over(Window.partitionBy("src_user"))
    return hours.withColumn("share", _share(F.col("logons"), total))


def baselines(activity: DataFrame, days: int = BASELINE_DAYS) -> DataFrame:
    """Each active day of a user against the active days among the `days` before it.

    Mean and deviation come from whole-number sums, so they do not depend on row order; the
    squares are decimals, which hold the sums of any count. The z-score is null with fewer
    than two earlier days or without any spread.
    """
    before = Window.partitionBy("src_user").orderBy("day_index").rangeBetween(-days, -1)
    count = F.col("auth_count")
    wide = lambda value: value.cast("decimal(19,0)")
    sums = activity.select(
        "src_user", "day_index", "auth_count",
        F.count("*").over(before).alias("n"),
        F.sum(count).over(before).alias("total"),
        F.sum((wide(count) * wide(count)).cast("decimal(38,0)")).over(before).alias("squares"),
    )
    mean = F.try_divide("total", "n")
    spread = F.try_divide(
        (
            (F.col("n").cast("decimal(6,0)") * F.col("squares").cast("decimal(31,0)")).cast("decimal(38,0)")
            - (wide(F.col("total")) * wide(F.col("total"))).cast("decimal(38,0)")
        ).cast("double"),
        F.col("n") * (F.col("n") - 1),
    )
    deviation = F.sqrt(spread)
    return sums.select(
        "src_user", "day_index", "auth_count",
        F.col("n").alias("baseline_days"),
        F.round(mean, 6).alias("baseline_mean"),
        F.round(deviation, 6).alias("baseline_stddev"),
        F.round(F.try_divide(count - mean, deviation), 6).alias("z_score"),
    )
