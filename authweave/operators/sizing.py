"""Broadcast only behind a check of the size."""

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authweave.workspace import pinned

BROADCAST_BYTES = 16 * 1024 * 1024


def is_small(frame: DataFrame) -> bool:
    """True when the values of the whole frame take at most BROADCAST_BYTES.

    One distributed sum; call it on frames that are cheap to read (pinned or small files).
    """
    widths = [
        F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) + F.lit(8)
        for name in frame.columns
    ]
    size = frame.agg(F.sum(reduce(add, widths).cast("long")).alias("size")).first().size
    return (size or 0) <= BROADCAST_BYTES


def join_checked(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join with a side that may be small; its own size is measured, so it should be cheap.

    Small: broadcast, the left side is not moved. Otherwise a shuffle join; the right side
    is pinned first, so it is read through a shuffle of its own, which is what adaptive
    execution needs to split the partitions of a hot key.
    """
    if is_small(right):
        return left.join(F.broadcast(right), on, how)
    return left.join(pinned(right), on, how)
