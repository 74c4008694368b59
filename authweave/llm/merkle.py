"""Merkle manifest of a table: a tree per source, a tree over the sources, a proof per row.

Rows are numbered by (source, id) with one range sort. `WIDTH` consecutive nodes become their
hash until one is left. A superblock is SUPER = WIDTH^3 consecutive nodes of one tree, three
levels of it. On the way up each superblock is reduced to a node of the next, SUPER times
smaller table, until every source has one node, and the same way on to the root. On the way
down the nodes of each superblock are cogrouped with the outer nodes that its proofs need
(siblings above the superblock, up to the root): there the inner levels are reduced again, the
inner siblings joined with the outer ones, and for rows the changed leaf folded to a root. No
task sees more than two superblocks at a time, however large a source is, and small trees share a task.
"""

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authweave.llm.tables import again, stored
from authweave.operators.ids import number_rows
from authweave.operators.sizing import join_checked

WIDTH = 16
LEVELS = 3  # inside a superblock
SUPER = WIDTH ** LEVELS

#: place: where the node stands in its run; run: the digests of its run, joined
STEPS = "array<struct<place: int, run: string>>"
DIGEST = 64  # characters
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values: list[Column]) -> Column:
    """Hash of the values, each as its number of bytes and itself, or a dash for a null."""
    texts = [value.cast("string") for value in values]
    parts = [
        F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts
    ]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _unit(tree: str = "tree") -> Column:
    """What goes to one task: a superblock of a large tree, or small trees that start near.

    A node's number counts on through all trees; a tree starts at `start`.
    """
    block = F.expr(f"start + ((number - start) div {SUPER}) * {SUPER}")
    return F.when(F.col("size") > SUPER, block * 2 + 1).otherwise(F.expr(f"(start div {SUPER}) * 2"))


def _levels(digests: list[str], whole: bool) -> list[list[str]]:
    """Levels of one superblock, its nodes first; `whole` if it is all of its tree.

    A whole tree ends with one node. A superblock of a larger tree always has LEVELS levels
    above its nodes, as the ones beside it do.
    """
    levels = [digests]
    while len(levels[-1]) > 1 if whole else len(levels) <= LEVELS:
        last = levels[-1]
        levels.append([digest("".join(last[at:at + WIDTH])) for at in range(0, len(last), WIDTH)])
    return levels


def _superblocks(frame: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, bool]]:
    frame = frame.sort_values("number", kind="stable")
    block = (frame["number"] - frame["start"]) // SUPER
    for _, part in frame.groupby([frame["start"], block], sort=True):
        yield part, part["size"].iloc[0] <= SUPER


def _reduced(nodes: DataFrame) -> DataFrame:
    """(tree, block, digest, size): one node per superblock, `size` of its own tree."""

    def reduce(frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for part, whole in _superblocks(frame):
            first = part.iloc[0]
            top = _levels(part["digest"].tolist(), whole)[-1][0]
            rows.append((first["tree"], (first["number"] - first["start"]) // SUPER, top, -(-first["size"] // SUPER)))
        return pd.DataFrame(rows, columns=["tree", "block", "digest", "size"])

    units = nodes.select("*", _unit().alias("unit")).groupBy("unit")
    return units.applyInPandas(reduce, "tree long, block long, digest string, size long")


def _numbered(blocks: DataFrame) -> DataFrame:
    """The nodes of the next table: `number` counts on through the trees, in tree order."""
    found = number_rows(blocks, ["tree", "block"], "number", 0)
    return found.select(
        "tree", (F.col("number") - F.col("block")).alias("start"), "size", "number", "digest"
    )


def _runs(levels: list[list[str]]) -> list[list[str]]:
    return [["".join(level[at:at + WIDTH]) for at in range(0, len(level), WIDTH)] for level in levels[:-1]]


def _steps(runs: list[list[str]], at: int) -> list[dict]:
    """The runs that the node at a place goes through, up to the superblock's top."""
    steps = []
    for level in runs:
        steps.append({"place": at % WIDTH, "run": level[at // WIDTH]})
        at //= WIDTH
    return steps


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """The tables of nodes, each SUPER times smaller than the one before, to one node per tree."""
    tables = [nodes]
    while tables[-1].where("size > 1").limit(1).count():
        tables.append(stored(_numbered(_reduced(tables[-1])), "nodes"))
    return tables


def _cogrouped(nodes: DataFrame, above: DataFrame, function, schema: str) -> DataFrame:
    """Nodes and what lies above their superblocks, by unit.

    `above` names superblocks by (tree, block). Where their tree starts and how long it is, which
    its unit follows from, is joined from the nodes: a row per tree.
    """
    trees = stored(nodes.select("tree", "start", "size").distinct(), "trees")
    placed = join_checked(above, trees, ["tree"], "inner").withColumn(
        "number", F.expr(f"start + block * {SUPER}")
    )
    left, right = (side.withColumn("unit", _unit()).groupBy("unit") for side in (nodes, placed))
    return left.cogroup(right).applyInPandas(function, schema)


def _further(outer: pd.DataFrame) -> dict[tuple[int, int], list[dict]]:
    """The outer steps of each superblock."""
    return {
        (tree, block): [{"place": step["place"], "run": step["run"]} for step in steps]
        for tree, block, steps in zip(outer["tree"], outer["block"], outer["steps"])
    }


def _outer(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, block, steps) from each node to the root: what the superblocks under it need."""

    def join(own: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        further = _further(outer)
        rows = []
        for part, whole in _superblocks(own):
            runs = _runs(_levels(part["digest"].tolist(), whole))
            for at, (tree, place) in enumerate(zip(part["tree"], part["number"] - part["start"])):
                rows.append((tree, place, _steps(runs, at) + further[tree, place // SUPER]))
        return pd.DataFrame(rows, columns=["tree", "block", "steps"])

    return stored(_cogrouped(nodes, above, join, f"tree long, block long, steps {STEPS}"), "outer")


def _fold(value: str, steps: list[dict]) -> str:
    for step in steps:
        at, run = step["place"] * DIGEST, step["run"]
        value = digest(run[:at] + value + run[at + DIGEST:])
    return value


def _siblings(steps: list[dict]) -> str:
    return "".join(
        step["run"][:step["place"] * DIGEST] + step["run"][(step["place"] + 1) * DIGEST:] for step in steps
    )


PROVED = "id string, leaf string, subroot string, proof_sha256 string, folded_root string, n_steps int"


def _prove(own: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Reduces superblocks of leaves, completes their proofs and folds the changed leaves."""
    further = _further(outer)
    subroots = dict(zip(outer["tree"], outer["subroot"]))
    rows = []
    for part, whole in _superblocks(own):
        first = part.iloc[0]
        runs = _runs(_levels(part["digest"].tolist(), whole))
        rest, subroot = further[first["tree"], (first["number"] - first["start"]) // SUPER], subroots[first["tree"]]
        for at, (name, value, changed) in enumerate(zip(part["id"], part["digest"], part["changed"])):
            steps = _steps(runs, at) + rest
            folded = _fold(value if changed is None else changed, steps)
            rows.append((name, value, subroot, digest(_siblings(steps)), folded, len(steps)))
    return pd.DataFrame(rows, columns=["id", "leaf", "subroot", "proof_sha256", "folded_root", "n_steps"])


def manifest(leaves: DataFrame) -> DataFrame:
    """Trees, proofs and verification of rows (id, source, leaf, changed).

    Returns id, leaf, subroot, root, proof_sha256, folded_root, verified, n_steps per row.
    `changed` is the leaf as it is found now, null where it was not touched. Sources are in byte
    order, null first, and so are the ids of a source, as longs; rows of one id by their leaf.
    """
    keyed = leaves.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("source"),  # null before empty text
        F.col("id").cast("long").alias("id"), "leaf", "changed",
    )
    placed = number_rows(keyed, ["source", F.asc_nulls_first("id"), "leaf"], "number", 0)
    sources = placed.groupBy("source").agg(F.min("number").alias("start"), F.count("*").alias("size"))
    trees = stored(number_rows(sources, ["source"], "tree", 0), "sources")
    # longs with nulls would be doubles in pandas
    nodes = stored(join_checked(placed, trees, ["source"], "inner").select(
        "tree", "start", "size", "number", F.col("leaf").alias("digest"), F.col("id").cast("string").alias("id"), "changed",
    ), "leaves")
    tables = _climb(nodes)
    tops = again(tables[-1]).select("tree", F.col("digest").alias("subroot"))
    count = trees.count()
    upper = _climb(stored(tops.select(
        F.lit(0).cast("long").alias("tree"), F.lit(0).cast("long").alias("start"),
        F.lit(count).cast("long").alias("size"), F.col("tree").alias("number"), F.col("subroot").alias("digest"),
    ), "nodes"))
    root = upper[-1].select("digest").first()
    above = again(upper[-1]).select("tree", F.lit(0).cast("long").alias("block"), F.array().cast(STEPS).alias("steps"))
    for level in reversed(upper[:max(1, len(upper) - 1)]):
        above = _outer(level, above)
    above = above.select(F.col("block").alias("tree"), F.lit(0).cast("long").alias("block"), "steps")
    for level in reversed(tables[1:-1]):
        above = _outer(level, above)
    proved = _cogrouped(nodes, above.join(tops, "tree"), _prove, PROVED)
    return proved.select(
        F.col("id").cast("long").alias("id"), "leaf", "subroot", F.lit(root.digest if root else None).alias("root"),
        "proof_sha256", "folded_root", (F.col("folded_root") == F.lit(root.digest if root else None)).alias("verified"),
        "n_steps",
    )


def audit(
    docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    every: int = 5,
) -> DataFrame:
    """The manifest of `docs` checked against a copy with some texts lower-cased (A-Z only).

    Touched are the rows whose checksum of the id in decimals is divisible by `every`. One row
    per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, n_steps.

    A null field, the id included, is hashed as a dash; a null id comes first in its source and
    is never touched, a null text stays null. Repeated rows are leaves of their own, of equal
    ids in the order of their leaves. A null source is a source, before the empty one. A lone
    row is its source's root, a lone source's root the root; an empty table gives no rows. Texts of
    any length are hashed in the scan and go no further. Other columns take no part.
    """
    name, source, *_, text = fields
    lowered = F.translate(text, UPPER, LOWER)
    touched = F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(every).cast("long")) == 0
    found = manifest(docs.select(
        F.col(name).alias("id"), F.col(source).cast("string").alias("source"),
        leaf([F.col(field) for field in fields]).alias("leaf"),
        F.when(touched, leaf([*[F.col(field) for field in fields[:-1]], lowered])).alias("changed"),
    ))
    return found.withColumnRenamed("id", name)
