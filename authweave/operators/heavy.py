"""The most frequent values in two passes, without shuffling every value."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authweave.operators.profile import most_frequent

TRACKED = 10_000  # values a sketch keeps
SPARE = 8  # candidates per wanted value
ERROR = 3.5 / 16_384  # share of all rows by which a sketch of TRACKED values is off at most


def heavy_hitters(
    log: DataFrame, name: str, count: int, tracked: int = TRACKED, error: float = ERROR
) -> tuple[DataFrame, bool]:
    """(`profile.most_frequent` of the column, whether two passes were enough).

    The first pass keeps a sketch of frequent items per task, of fixed size, and merges the
    sketches. The second counts its best candidates, and null, exactly. The sketch leaves out
    values that it may have counted too high by more than they are worth: what it does not
    name occurs at most twice its error, or as often as the last candidate was estimated. If the
    last wanted value occurs more often than that, or if the candidates are all there is, the
    result is proved; otherwise all values are counted.
    """
    value = F.col(name)
    wide = min(count * SPARE, tracked)
    sketch = F.expr(f"approx_top_k(`{name}`, {wide}, {tracked}) FILTER (WHERE `{name}` IS NOT NULL)")
    top = log.agg(sketch.alias("top"), F.count("*").alias("n"), F.count(value).alias("known")).first()
    candidates = [row["item"] for row in top.top or []]
    counted = log.filter(value.isin(candidates) | value.isNull()).groupBy(name).agg(F.count("*").alias("rows"))
    rows = counted.orderBy(F.desc("rows"), F.asc_nulls_last(name)).collect()  # `wide` rows and one at most
    last = top.top[-1]["count"] if len(candidates) == wide else 0
    floor = max(last, 2 * error * top.known)
    complete = sum(row["rows"] for row in rows) == top.n
    if not complete and (len(rows) < count or rows[count - 1]["rows"] <= floor):
        return most_frequent(log, name, count), False
    return log.sparkSession.createDataFrame([tuple(row) for row in rows[:count]], counted.schema), True


def top_values(log: DataFrame, name: str, count: int) -> DataFrame:
    return heavy_hitters(log, name, count)[0]
