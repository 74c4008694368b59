"""Dense row numbers and running totals without sending all rows through one task."""

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from authweave.workspace import pinned

_PARTITION = "_partition"
_PLACE = "_place"


def _ordered_partitions(frame: DataFrame, order: list[str | Column]) -> DataFrame:
    """Globally sorted rows, pinned, with partition number and place inside it.

    The tie-breaker makes each sort key unique, so the range shuffle can cut through
    a run of equal keys however long it is.
    """
    tied = frame.withColumn("_tie", F.monotonically_increasing_id())
    rows = pinned(tied.orderBy(*order, "_tie").drop("_tie"))
    part = F.spark_partition_id()
    place = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    return rows.withColumns({_PARTITION: part, _PLACE: place})


def _before(placed: DataFrame, amount: Column) -> Column:
    """Sum of `amount` over all earlier partitions: one number per partition is collected."""
    found = placed.groupBy(_PARTITION).agg(amount.alias("amount")).collect()
    amounts = {row[_PARTITION]: row.amount for row in found}
    last = max(amounts, default=0)
    starts = list(accumulate((amounts.get(part, 0) for part in range(last)), initial=0))
    listed = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    return F.element_at(listed, F.col(_PARTITION) + 1)


def number_rows(frame: DataFrame, order: list[str | Column], name: str, start: int) -> DataFrame:
    """Adds `name` = start, start+1, ... over the whole table in the given order.

    Rows equal in `order` get consecutive numbers in no particular order.
    """
    placed = _ordered_partitions(frame, order)
    number = _before(placed, F.count("*")) + F.col(_PLACE) + F.lit(start)
    return placed.withColumn(name, number).select(name, *frame.columns)


def running_total(frame: DataFrame, order: list[str | Column], value: str, name: str) -> DataFrame:
    """Adds `name` = sum of `value` over all rows up to this one.

    Partition totals are added to the running sum inside each range partition. Rows
    should be distinct in `order`, so no partition is oversized.
    """
    placed = _ordered_partitions(frame, order)
    so_far = Window.partitionBy(_PARTITION).orderBy(_PLACE).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    total = _before(placed, F.sum(value)) + F.sum(value).over(so_far)
    return placed.withColumn(name, total).select(*frame.columns, name)
