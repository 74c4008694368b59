"""Alerts of one user that follow each other closely, as incidents."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP_SECONDS = 6 * 3600
LISTED = 20  # alerts in one row of an incident; a longer one has several rows


def incidents(
    alerts: DataFrame, gap: int = GAP_SECONDS, listed: int = LISTED, known: tuple[str, ...] = ("dst_computer", "score")
) -> DataFrame:
    """A row per incident of a user and part: its span, its alerts and what they add up to.

    An alert at most `gap` seconds after the one before it belongs to the same incident. A
    part lists up to `listed` alerts (time and the `known` columns) in order of time, so that no
    row grows with the incident; the counts are those of the whole incident. Alerts without a
    time are in none; equal times are in the order of the other columns.
    """
    timed = alerts.filter(F.col("time").isNotNull()).withColumn("_at", F.timestamp_seconds("time"))
    session = F.session_window("_at", f"{gap} seconds")
    found = timed.groupBy("user", session.alias("_session")).agg(
        F.min("time").alias("first_time"), F.max("time").alias("last_time"),
        F.count("*").alias("alerts"), F.max("score").alias("worst_score"),
        F.sum("auth_count").alias("auth_count"), F.sum("failed_count").alias("failed_count"),
        F.array_sort(F.collect_list(F.struct("time", *known))).alias("_all"),
    )
    last = F.ceil(F.size("_all") / F.lit(listed)).cast("int") - 1
    return found.withColumn("part", F.explode(F.sequence(F.lit(0), last))).select(
        "user", "first_time", "last_time", "part", "alerts", "worst_score", "auth_count", "failed_count",
        F.slice("_all", F.col("part") * listed + 1, listed).alias("listed"),
    )


def as_line(listed: Column) -> Column:
    """The listed alerts as text: time@host, one after another."""
    return F.array_join(F.transform(listed, lambda a: F.concat(a.time.cast("string"), F.lit("@"), a.dst_computer)), " ")
