"""Features of users and hosts, and the graph as a block-sparse matrix to spread them with.

The normalised adjacency has an entry count / sqrt(count of the user * count of the host)
per edge. Entries are kept by block: SIDE users by SIDE hosts, so a block has SIDE * SIDE entries
at most and a product joins blocks with blocks of features, not every entry with its row.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authweave.operators.sizing import join_checked
from authweave.workspace import pinned

SIDE = 256


def host_features(edge_table: DataFrame) -> DataFrame:
    """One numeric row per destination host, from the edges alone (no labels)."""
    return edge_table.groupBy("dst_computer").agg(
        F.count("*").alias("users"),
        F.sum("auth_count").alias("auth_count"),
        F.round(F.try_divide(F.sum("failed_count"), F.sum("auth_count")), 6).alias("failed_share"),
        F.round(F.try_divide(F.sum("cross_host_count"), F.sum("auth_count")), 6).alias("cross_host_share"),
        F.max("active_days").alias("most_active_days"),
        F.round(F.try_divide(F.max("auth_count"), F.sum("auth_count")), 6).alias("largest_user_share"),
    )


def adjacency(indexed_edges: DataFrame) -> DataFrame:
    """(row_block, col_block, entries): entries are (row, col, weight), numbered within the block.

    `indexed_edges` has user_id, host_id and auth_count, a row per edge, as `graph.edge_index`
    gives them; it is read several times and should be pinned. Counts per node are one row
    each; an edge meets both of its nodes' counts, and blocks are made after that.
    """
    users = pinned(indexed_edges.groupBy("user_id").agg(F.sum("auth_count").alias("of_user")))
    hosts = pinned(indexed_edges.groupBy("host_id").agg(F.sum("auth_count").alias("of_host")))
    counted = join_checked(join_checked(indexed_edges, users, ["user_id"], "inner"), hosts, ["host_id"], "inner")
    weight = F.col("auth_count") / F.sqrt(F.col("of_user").cast("double") * F.col("of_host"))
    entry = F.struct(
        F.pmod("user_id", F.lit(SIDE)).cast("int").alias("row"), F.pmod("host_id", F.lit(SIDE)).cast("int").alias("col"),
        weight.alias("weight"),
    )
    return counted.groupBy(_block("user_id").alias("row_block"), _block("host_id").alias("col_block")).agg(
        F.array_sort(F.collect_list(entry)).alias("entries")
    )


def feature_blocks(features: DataFrame, number: str, names: list[str]) -> DataFrame:
    """(block, rows): the features of SIDE nodes as a map from their place to an array of doubles."""
    values = F.array(*[F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in names])
    place = F.pmod(number, F.lit(SIDE)).cast("int")
    return features.groupBy(_block(number).alias("block")).agg(
        F.map_from_entries(F.collect_list(F.struct(place, values))).alias("rows")
    )


def entries_of(blocks: DataFrame) -> DataFrame:
    """(user_id, host_id, weight): the matrix entry by entry."""
    one = blocks.select("row_block", "col_block", F.explode("entries").alias("e"))
    return one.select(
        (F.col("row_block") * SIDE + F.col("e.row")).alias("user_id"),
        (F.col("col_block") * SIDE + F.col("e.col")).alias("host_id"), F.col("e.weight").alias("weight"),
    )


def spread_to_users(blocks: DataFrame, host_blocks: DataFrame, names: list[str]) -> DataFrame:
    """(user_id, names): the matrix times the hosts' features; hosts without features count as zeros.

    A block of features goes to each block of its column once. The products are added up inside
    their block before they are sent to their user's row.
    """
    joined = blocks.join(
        host_blocks.withColumnRenamed("block", "col_block"), "col_block", "left"
    ).select("row_block", "rows", F.explode("entries").alias("e"))
    row = (F.col("row_block") * SIDE + F.col("e.row")).alias("user_id")
    values = F.element_at("rows", F.col("e.col"))
    weighted = joined.select(row, F.col("e.weight").alias("weight"), values.alias("values"))
    return weighted.groupBy("user_id").agg(*[
        F.sum(F.coalesce(F.col("weight") * F.get("values", F.lit(k)), F.lit(0.0))).alias(name)
        for k, name in enumerate(names)
    ])


def _block(number: str) -> Column:
    return F.expr(f"{number} div {SIDE}")
