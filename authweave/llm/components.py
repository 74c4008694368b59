"""Connected components of links between integer ids, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authweave.llm.tables import forget, stored


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest id around the node."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return (
        both.where("v > u").join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where("u != v").distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row.n, row.h


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component): the smallest id that links lead to, for ids that have a smaller one.

    Ids missing from the result are the smallest of their component. Links that name an
    id twice or hold a null count as none. Each round is two grouped minima and two joins;
    the number of rounds grows with the logarithm of the longest chain.
    """
    now = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u != v").distinct(),
        "links",
    )
    before = _state(now)
    while before[0]:
        later = stored(_small_star(_large_star(now)), "links")
        forget(now)
        now, state = later, _state(later)
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
