"""Known attacks against the authentication log."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from authweave.functions.clock import day_index
from authweave.functions.flags import flag
from authweave.operators.clean import before_day
from authweave.operators.ids import number_rows
from authweave.operators.sizing import is_small, join_checked
from authweave.schemas import AUTH_KEY, AUTH_TEXT_COLUMNS, REDTEAM_KEY, REDTEAM_TEXT_COLUMNS
from authweave.workspace import pinned

FIRST_EVENTS = 10


def file_order(redteam: DataFrame) -> list[str]:
    """File and line where the log has line numbers, else time and names."""
    if "source_row" not in redteam.columns:
        return REDTEAM_KEY
    return [name for name in ("file", "source_row") if name in redteam.columns]


def number_events(redteam: DataFrame, name: str = "redteam_id", start: int = 1) -> DataFrame:
    """Events with a usable time, numbered in file order."""
    timed = redteam.filter(F.col("time").isNotNull())
    return number_rows(timed, file_order(redteam), name, start)


def first_events(redteam: DataFrame, count: int = FIRST_EVENTS) -> DataFrame:
    """The first events in file order, ids from 1.

    The window is one task that sees `count` rows: meant for reports of up to some 100,000.
    """
    order = file_order(redteam)
    first = redteam.filter(F.col("time").isNotNull()).orderBy(*order).limit(count)
    number = F.row_number().over(Window.orderBy(*order)).cast("long")
    return first.select(number.alias("redteam_id"), *REDTEAM_KEY)


def normalize_events(redteam: DataFrame) -> DataFrame:
    return redteam.withColumns(
        {name: F.upper(F.trim(F.col(name))) for name in REDTEAM_TEXT_COLUMNS}
    )


def _auth_key(events: DataFrame) -> list[Column]:
    return [F.col(event).alias(auth) for event, auth in zip(REDTEAM_KEY, AUTH_KEY)]


def _in_reach(log: DataFrame, events: DataFrame) -> DataFrame:
    """Log rows between the first and the last event, on the events' days where the log has them.

    Bounds and days are fetched from the events first, so the scan gets them as literals:
    they skip row groups and, in a table by day, folders. A clean row in the folder of
    another day than its time's is not found; the quality checks report such rows.
    """
    bounds = events.agg(F.min("time").alias("low"), F.max("time").alias("high")).first()
    if bounds.low is None:
        return log.filter(F.lit(False))
    near = log.filter(F.col("time").between(bounds.low, bounds.high))
    if "day_index" in log.columns:
        days = events.filter("time IS NOT NULL").select(day_index(F.col("time")).alias("day")).distinct()
        near = near.filter(F.col("day_index").isin([row.day for row in days.collect()]))
    return near


def raw_matches(auth: DataFrame, events: DataFrame) -> DataFrame:
    """Authentication rows that equal an attack in all four key fields, text as logged.

    A row is listed once for each event that has its key.
    """
    keyed = events.select("redteam_id", *_auth_key(events))
    rows = _in_reach(auth, events).select("time", *AUTH_TEXT_COLUMNS)
    return join_checked(rows, keyed, AUTH_KEY, "inner").select(
        "redteam_id",
        F.col("time").alias("redteam_time"),
        F.col("src_user").alias("redteam_user"),
        *AUTH_TEXT_COLUMNS,
    )


def matches_per_event(log: DataFrame, events: DataFrame) -> DataFrame:
    """Every event with the number of log rows that equal it, 0 when there is none.

    Works on counts per key, never on pairs of rows: the log is reduced to the events' keys
    before it is counted. `events` should be pinned or a small file.
    """
    names = [f"_{name}" for name in AUTH_KEY]
    keyed = events.withColumns(dict(zip(names, map(F.col, REDTEAM_KEY))))
    rows = _in_reach(log, events).select(
        [F.col(name).alias(key) for name, key in zip(AUTH_KEY, names)]
    )
    count = F.count("*").alias("matches")
    if is_small(events):
        kept = rows.join(F.broadcast(keyed.select(names)), names, "left_semi")
        counts = F.broadcast(kept.groupBy(names).agg(count))
    else:
        keys = pinned(keyed.select(names).distinct())
        counts = pinned(rows.join(keys, names, "left_semi").groupBy(names).agg(count))
    return keyed.join(counts, names, "left").select(
        *events.columns, F.coalesce("matches", F.lit(0)).cast("long").alias("matches")
    )


def unmatched_events(auth: DataFrame, events: DataFrame) -> DataFrame:
    return matches_per_event(auth, events).filter(F.col("matches") == 0).drop("matches")


def match_summary(counted: DataFrame) -> DataFrame:
    """One row over events with `matches`: tested, found, share found in percent."""
    tested = F.count("*")
    found = F.count_if(F.col("matches") > 0)
    share = F.coalesce(F.try_divide(found, tested) * 100, F.lit(0.0))
    return counted.agg(
        tested.alias("redteam_events_tested"),
        found.alias("redteam_events_with_exact_auth_match"),
        F.round(share, 2).alias("exact_auth_match_rate_percent"),
    )


def match_rate(auth: DataFrame, events: DataFrame) -> DataFrame:
    return match_summary(matches_per_event(auth, events))


def events_preserved(clean: DataFrame, events: DataFrame) -> DataFrame:
    """Events with their matches in the clean table, compared as normalized text."""
    counted = matches_per_event(clean, normalize_events(events))
    return counted.withColumnRenamed("matches", "processed_match_count").withColumn(
        "preserved", flag(F.col("processed_match_count") > 0)
    )


def preservation(clean: DataFrame, redteam: DataFrame, days: int) -> DataFrame:
    """Attacks of the first `days` days, numbered from 0, each with its matches."""
    return events_preserved(clean, number_events(before_day(redteam, days), "event_id", 0))


def preservation_summary(preserved: DataFrame) -> DataFrame:
    """One row; passes only when there are attacks and all of them were found."""
    events = F.count("*")
    found = F.count_if(F.col("preserved") == 1)
    share = F.coalesce(F.try_divide(found, events) * 100, F.lit(0.0))
    return preserved.agg(
        events.alias("events_in_window"),
        found.alias("events_preserved"),
        F.round(share, 6).alias("preservation_rate_percent"),
        ((events > 0) & (events == found)).alias("pass"),
    )
