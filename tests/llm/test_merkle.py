import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from authweave.llm import merkle
from pyspark.sql import functions as F

FIELDS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, number int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k:k + 16])) for k in range(0, len(levels[-1]), 16)])
    return levels


def by_hand(leaves):
    """[(id, source, leaf, changed)] -> sorted rows of the manifest."""
    trees = defaultdict(list)
    for row in leaves:
        trees[b"" if row[1] is None else b"=" + row[1].encode()].append(row)
    for rows in trees.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    order = sorted(trees)
    lower = {s: levels_of([r[2] for r in trees[s]]) for s in order}
    upper = levels_of([lower[s][-1][0] for s in order])
    out = []
    for rank, s in enumerate(order):
        for place, (name, _, leaf, changed) in enumerate(trees[s]):
            value, siblings, steps = leaf if changed is None else changed, "", 0
            for at, levels in ((place, lower[s]), (rank, upper)):
                for level in levels[:-1]:
                    first = at // 16 * 16
                    run = level[first:first + 16]
                    siblings += "".join(run[:at - first] + run[at - first + 1:])
                    value = sha("".join([*run[:at - first], value, *run[at - first + 1:]]))
                    at, steps = at // 16, steps + 1
            out.append((str(name), leaf, lower[s][-1][0], upper[-1][0], sha(siblings), value, value == upper[-1][0], steps))
    return sorted(out)


def rows_of(frame, name):
    return sorted(
        (str(r[name]), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified, r.n_steps)
        for r in frame.collect()
    )


@pytest.mark.parametrize("sizes", [
    {"a": 4097, "b": 70_000, None: 4096, "": 1, "é": 17, "z": 2},
    {f"s{k}": 1 + k % 3 for k in range(9000)},
    {"only": 16}, {"only": 1}, {"one": 1, "two": 1},
])
def test_large_trees_equal_brute_force(spark, sizes):
    """Trees of several superblocks, many small trees, and lone rows."""
    leaves, n = [], 0
    for source, size in sizes.items():
        for k in range(size):
            n += 7_919
            leaves.append(((n * 31) % 1_000_003 + (1 << 60), source, sha(str(n)), sha(f"x{n}") if n % 5 == 0 else None))
    random.Random(1).shuffle(leaves)
    frame = spark.createDataFrame(leaves, "id long, source string, leaf string, changed string")
    assert rows_of(merkle.manifest(frame.repartition(7)), "id") == by_hand(leaves)


def test_audit_equals_brute_force(spark):
    random.seed(2)
    some = lambda *values: random.choice([None, *values])
    rows = [
        (some(*range(200)), some("", "A", "b", "É"), some("en", ""), some(0, 12, -3), some("", "lower", "UPPER é É", "漢字A"), "x", 1)
        for _ in range(400)
    ]
    rows += [(300, "A", "en", 5, "Twice", "x", 1)] * 3 + [(301, "long", None, 1, "Long " * 100_000, "x", 1)]
    leaves = []
    for name, source, lang, n, text, *_ in rows:
        def hashed(t):
            parts = [None if v is None else str(v) for v in (name, source, lang, n, t)]
            return sha("".join("-" if p is None else f"{len(p.encode())}:{p}" for p in parts))
        touched = name is not None and zlib.crc32(str(name).encode()) % 5 == 0
        low = text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        leaves.append((name, source, hashed(text), hashed(low) if touched else None))
    found = merkle.audit(spark.createDataFrame(rows, FIELDS))
    expected = by_hand(leaves)
    assert rows_of(found, "doc_id") == expected
    assert 0 < sum(not row[6] for row in expected) < 100
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "n_steps"]


def test_empty_table(spark):
    empty = spark.createDataFrame([], FIELDS)
    assert merkle.audit(empty).count() == 0


def test_superblocks_are_bounded(spark):
    """No unit of work holds more than two superblocks of rows."""
    frame = spark.range(50_000).select(
        F.when(F.col("id") < 20_000, 0).otherwise(F.col("id").cast("int")).alias("tree"), "id"
    )
    nodes = frame.groupBy("tree").agg(F.min("id").alias("start"), F.count("*").alias("size")).join(
        frame.withColumnRenamed("id", "number"), "tree"
    )
    units = nodes.groupBy(merkle._unit()).agg(F.count("*").alias("n"))
    assert units.agg(F.max("n")).first()[0] <= 2 * merkle.SUPER
