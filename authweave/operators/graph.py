"""User-host graph as node and edge tables, and labels beside it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authweave.functions.flags import flag
from authweave.operators.ids import number_rows
from authweave.operators.redteam import normalize_events
from authweave.operators.sizing import join_checked
from authweave.schemas import AUTH_KEY, UNKNOWN

USER = "user"
HOST = "host"


def nodes(clean: DataFrame) -> DataFrame:
    """Users and hosts with the number of rows they are source or destination of.

    Only the destination user is ever filled in by the cleaning, so only there the fill
    value stands for nobody; a source user or a host of that name is a node like others.
    """
    ends = [(USER, "src_user", 1), (USER, "dst_user", 0), (HOST, "src_computer", 1), (HOST, "dst_computer", 0)]
    roles = F.array(*[
        F.struct(
            F.lit(kind).alias("node_type"), F.col(name).alias("node"), F.lit(source).alias("source")
        )
        for kind, name, source in ends
    ])
    return (
        clean.select(F.inline(roles))
        .filter(~((F.col("node_type") == USER) & (F.col("source") == 0) & (F.col("node") == UNKNOWN)))
        .groupBy("node_type", "node")
        .agg(
            F.count_if(F.col("source") == 1).alias("as_source"),
            F.count_if(F.col("source") == 0).alias("as_destination"),
        )
    )


def edges(edges_by_day: DataFrame) -> DataFrame:
    """One edge per user and destination host, with its attributes."""
    sums = ["auth_count", "failed_count", "successful_count", "cross_host_count"]
    return edges_by_day.groupBy("src_user", "dst_computer").agg(
        *[F.sum(name).alias(name) for name in sums],
        F.count("*").alias("active_days"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.min("day_index").alias("first_day"),
    )


def node_index(all_nodes: DataFrame, kind: str) -> DataFrame:
    """(node_id from 0, node) for one kind of node, in name order."""
    named = all_nodes.filter(F.col("node_type") == kind).select("node")
    return number_rows(named, ["node"], "node_id", 0)


def edge_index(
    all_edges: DataFrame, users: DataFrame, hosts: DataFrame, split_day: int
) -> DataFrame:
    """Edges by node number; edges first seen from `split_day` on are test edges."""
    user_ids = users.select(F.col("node").alias("src_user"), F.col("node_id").alias("user_id"))
    host_ids = hosts.select(F.col("node").alias("dst_computer"), F.col("node_id").alias("host_id"))
    named = join_checked(all_edges, user_ids, ["src_user"], "inner")
    both = join_checked(named, host_ids, ["dst_computer"], "inner")
    return both.select(
        "user_id", "host_id", "auth_count", "failed_count",
        F.when(F.col("first_day") < split_day, "train").otherwise("test").alias("split"),
    )


def node_features(edge_table: DataFrame) -> DataFrame:
    """One numeric row per user, from the edges alone (no labels)."""
    return edge_table.groupBy("src_user").agg(
        F.count("*").alias("hosts"),
        F.sum("auth_count").alias("auth_count"),
        F.round(F.try_divide(F.sum("failed_count"), F.sum("auth_count")), 6).alias("failed_share"),
        F.round(F.try_divide(F.sum("cross_host_count"), F.sum("auth_count")), 6).alias("cross_host_share"),
        F.max("active_days").alias("most_active_days"),
    )


def label_rows(clean: DataFrame, redteam: DataFrame) -> DataFrame:
    """Key and label of every clean row: 1 when an attack has the same key.

    The label table stands apart from the feature tables. Attack keys are made
    distinct first, so no row is repeated.
    """
    events = normalize_events(redteam).select(
        F.col("time"), F.col("user").alias("src_user"), "src_computer", "dst_computer"
    )
    known = events.distinct().withColumn("_attack", F.lit(True))
    return join_checked(clean.select(*AUTH_KEY), known, AUTH_KEY, "left").select(
        *AUTH_KEY, flag(F.col("_attack")).alias("label")
    )
