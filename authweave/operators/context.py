"""Process activity around events: same host, at most 300 seconds apart.

The events are read several times: hand them over pinned, or as a small file.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authweave.functions.clock import floor_div
from authweave.operators.sizing import join_checked
from authweave.schemas import CONTEXT_WINDOW_SECONDS
from authweave.workspace import pinned


def _hosts(events: DataFrame) -> DataFrame:
    """One row per event and distinct host involved."""
    both = F.array_distinct(F.array("src_computer", "dst_computer"))
    return events.withColumn("_host", F.explode(both)).filter(F.col("_host").isNotNull())


def _spread(time: Column, window: int) -> Column:
    """The event's time slot and its two neighbours: any row in reach is in one of them."""
    slot = floor_div(time, window)
    return F.explode(F.sequence(slot - 1, slot + 1))


def _near(process_time: Column, event_time: Column, window: int) -> Column:
    return F.abs(process_time - event_time) <= window


def _within_reach(process: DataFrame, events: DataFrame, window: int) -> DataFrame:
    """Rows between the first and the last event, window included.

    The bounds are fetched first, so the scan gets them as literals.
    """
    bounds = events.agg(F.min("time").alias("low"), F.max("time").alias("high")).first()
    return _between(process, bounds.low, bounds.high, window)


def _between(process: DataFrame, low: int | None, high: int | None, window: int) -> DataFrame:
    if low is None:
        return process.filter(F.lit(False))
    return process.filter(F.col("time").between(low - window, high + window))


def process_context(
    events: DataFrame, process: DataFrame, id_name: str = "redteam_id",
    window: int = CONTEXT_WINDOW_SECONDS,
) -> DataFrame:
    """Pairs of event and process row, 13 columns.

    An equality join on host and time slot with the exact distance as residual, so the
    candidates of a busy host stay within three slots. The outer time bounds reach the
    process scan as a filter.
    """
    reach = _hosts(events).select(
        id_name,
        F.col("time").alias("redteam_time"),
        F.col("user").alias("redteam_user"),
        F.col("src_computer").alias("redteam_src_computer"),
        F.col("dst_computer").alias("redteam_dst_computer"),
        F.col("_host").alias("computer"),
        _spread(F.col("time"), window).alias("_slot"),
    )
    rows = _within_reach(process, events, window).select(
        F.col("time").alias("process_time"),
        F.col("user").alias("process_user"),
        "computer", "process", "event_type",
        floor_div(F.col("time"), window).alias("_slot"),
    )
    pairs = join_checked(rows, reach, ["computer", "_slot"], "inner").filter(
        _near(F.col("process_time"), F.col("redteam_time"), window)
    )
    role = F.when(F.col("computer") == F.col("redteam_src_computer"), "source_host")
    return pairs.select(
        id_name, "redteam_time", "redteam_user", "redteam_src_computer", "redteam_dst_computer",
        "process_time",
        F.abs(F.col("process_time") - F.col("redteam_time")).alias("time_difference_seconds"),
        "process_user", "computer",
        role.otherwise("destination_host").alias("host_role"),
        (F.col("process_user") == F.col("redteam_user")).alias("same_user_as_redteam"),
        "process", "event_type",
    )


def context_summary(
    events: DataFrame, process: DataFrame, window: int = CONTEXT_WINDOW_SECONDS
) -> DataFrame:
    """One row: pairs in reach, and those by the attacking user.

    One pass over counts per host, second and user, instead of the pairs.
    """
    reach = (
        _hosts(events).groupBy(
            F.col("_host").alias("computer"), F.col("user").alias("event_user"),
            F.col("time").alias("event_time"),
        ).agg(F.count("*").alias("events"))
        .withColumn("_slot", _spread(F.col("event_time"), window))
    )
    rows = (
        _within_reach(process, events, window)
        .groupBy("computer", "user", "time").agg(F.count("*").alias("rows"))
        .withColumn("_slot", floor_div(F.col("time"), window))
    )
    pairs = F.col("events") * F.col("rows")
    same_user = F.when(F.col("user") == F.col("event_user"), pairs)
    return (
        rows.join(reach, ["computer", "_slot"])
        .filter(_near(F.col("time"), F.col("event_time"), window))
        .agg(
            F.coalesce(F.sum(pairs), F.lit(0)).alias("process_context_events_found"),
            F.coalesce(F.sum(same_user), F.lit(0)).alias("same_user_process_context_events"),
            F.lit(window).alias("process_context_window_seconds"),
        )
    )


def process_evidence(
    contacts: DataFrame, process: DataFrame, keys: list[str],
    window: int = CONTEXT_WINDOW_SECONDS,
) -> DataFrame:
    """Per alert (`keys`): process rows near any of its contacts, on either host involved.

    `contacts` has the keys, user, time, src_computer and dst_computer. Counted are process
    rows, those by the contact's user, kinds of process, and the time span; a row near
    several contacts counts once. Of the contacts only the first and last per host and
    300-second slot matter: whether a row is near a contact of its own slot or a neighbouring
    one is decided by these two. Process rows are counted per host, second, user and kind
    before the join.
    """
    named = list(dict.fromkeys([*keys, "user"]))
    slots = pinned(
        _hosts(contacts)
        .groupBy(*named, F.col("_host").alias("computer"), floor_div(F.col("time"), window).cast("long").alias("_at"))
        .agg(F.min("time").alias("_first"), F.max("time").alias("_last"))
    )
    bounds = slots.agg(F.min("_first").alias("low"), F.max("_last").alias("high")).first()
    rows = (
        _between(process, bounds.low, bounds.high, window)
        .groupBy("computer", "time", F.col("user").alias("process_user"), "process")
        .agg(F.count("*").alias("rows"))
        .withColumn("_slot", floor_div(F.col("time"), window))
    )
    reach = slots.withColumn("_slot", F.explode(F.sequence(F.col("_at") - 1, F.col("_at") + 1)))
    near = join_checked(rows, reach, ["computer", "_slot"], "inner").filter(
        (F.col("_last") >= F.col("time") - window) & (F.col("_first") <= F.col("time") + window)
    )
    own = F.when(F.col("process_user") == F.col("user"), F.col("rows")).otherwise(0)
    once = near.groupBy(*keys, "computer", "time", "process_user", "process").agg(
        F.max("rows").alias("rows"), F.max(own).alias("own")
    )
    kinds = once.groupBy(*keys, "process").agg(
        F.sum("rows").alias("rows"), F.sum("own").alias("own"),
        F.min("time").alias("first_time"), F.max("time").alias("last_time"),
    )
    return kinds.groupBy(*keys).agg(
        F.sum("rows").alias("process_events"),
        F.sum("own").alias("same_user_process_events"),
        F.count("process").alias("distinct_processes"),
        F.min("first_time").alias("first_process_time"),
        F.max("last_time").alias("last_process_time"),
    )
