"""Fields derived from the seconds counter of the logs.

The arithmetic stays on longs, so it is exact for every value. A time far outside
the collection gives a null field (found by the null check) instead of failing the job.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from authweave.schemas import SECONDS_PER_DAY, SECONDS_PER_HOUR


def floor_div(value: Column, width: int) -> Column:
    """Floor of value / width for a long column, negative values included."""
    return F.call_function("div", F.try_subtract(value, F.pmod(value, F.lit(width))), F.lit(width))


def day_index(time: Column) -> Column:
    return floor_div(time, SECONDS_PER_DAY).try_cast("int")


def second_of_day(time: Column) -> Column:
    return F.pmod(time, F.lit(SECONDS_PER_DAY)).cast("int")


def hour_of(second: Column) -> Column:
    return F.call_function("div", second, F.lit(SECONDS_PER_HOUR)).cast("int")
