"""Core numbers of the user-host graph: how deep in its dense part a node lies.

The core number of a node is the largest k such that it is in a set of nodes that all have k
neighbours within the set. A user with one unusual host has 1 whatever the host's degree
is; accounts and servers that everybody uses have the highest.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from authweave.operators.graph import HOST, USER, node_index
from authweave.operators.sizing import join_checked
from authweave.workspace import pinned


def _lowered(arcs: DataFrame, values: DataFrame) -> DataFrame:
    """(node, value): the largest h with h neighbours of value h or more; counts before windows.

    A node's window holds one row per value of its neighbours, however many they are.
    """
    seen = arcs.join(values.select(F.col("node").alias("b"), "value"), "b")
    counts = seen.groupBy(F.col("a").alias("node"), "value").agg(F.count("*").alias("n"))
    down = Window.partitionBy("node").orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("h", F.least("value", F.sum("n").over(down))).groupBy("node").agg(
        F.max("h").alias("value")
    )


def core_numbers(edges: DataFrame) -> tuple[DataFrame, int]:
    """((node, degree, core) of each node of distinct undirected edges (a, b); rounds needed).

    Every value starts as the degree, and becomes the largest h that h neighbours support, until
    a round changes none: that is the core number. The values are reliable checkpoints, a row per
    node; lost executors cost at most one round.
    """
    arcs = pinned(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    degrees = pinned(arcs.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("value")))
    values, rounds = degrees, 0
    while True:
        rounds += 1
        lower = _lowered(arcs, values).withColumnRenamed("value", "h")
        now = pinned(values.join(lower, "node").select("node", F.col("h").alias("value"), (F.col("h") < F.col("value")).alias("moved")))
        values = now.select("node", "value")
        if not now.filter("moved").limit(1).count():
            return degrees.withColumnRenamed("value", "degree").join(
                values.withColumnRenamed("value", "core"), "node"
            ), rounds


def node_structure(all_nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node_type, node, degree, core) of every user and host; both 0 without an edge.

    `all_nodes` comes from `graph.nodes`, `edges` from `graph.edges`; both are read several
    times and should be pinned. The graph joins users with the hosts they reached, whatever
    names they share: users have even numbers, hosts odd ones.
    """
    sides = {
        kind: pinned(node_index(all_nodes, kind).select("node", (F.col("node_id") * 2 + odd).alias("number")))
        for kind, odd in ((USER, 0), (HOST, 1))
    }
    named = edges.select("src_user", "dst_computer")
    for kind, column, end in ((USER, "src_user", "a"), (HOST, "dst_computer", "b")):
        ids = sides[kind].select(F.col("node").alias(column), F.col("number").alias(end))
        named = join_checked(named, ids, [column], "inner")
    cores, _ = core_numbers(named)
    both = [table.select(F.lit(kind).alias("node_type"), "node", "number") for kind, table in sides.items()]
    found = both[0].unionByName(both[1]).join(cores.withColumnRenamed("node", "number"), "number", "left")
    zero = F.lit(0).cast("long")
    return found.select(
        "node_type", "node", F.coalesce("degree", zero).alias("degree"), F.coalesce("core", zero).alias("core")
    )
