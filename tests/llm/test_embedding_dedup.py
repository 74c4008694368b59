import math
import random

import numpy as np
import pytest
from authweave.llm import embedding_dedup


def cosine(a, b):
    if len(a) != len(b):
        return -1
    top_a, top_b = max(map(abs, a)), max(map(abs, b))
    a, b = [x / top_a for x in a], [x / top_b for x in b]
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))


def by_hand(rows, threshold):
    able = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    group = {i: i for i, _ in rows if i is not None}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    counts = {}
    for p, (i, v) in enumerate(able):
        for q, (j, w) in enumerate(able):
            if p != q and cosine(v, w) >= threshold:
                counts[p] = counts.get(p, 0) + 1
                low, high = sorted((root(i), root(j)))
                group[high] = low
    out = [(i, counts.get(p, 0), root(i), root(i) == i) for p, (i, _) in enumerate(able)]
    rest = list(rows)
    for row in able:
        rest.remove(row)
    out += [(i, 0, i if i is None else root(i), i is not None) for i, _ in rest]
    return sorted(out, key=str)


def run(spark, rows, threshold=0.9):
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, n int, block int")
    return sorted((tuple(r) for r in embedding_dedup.near_duplicates(frame, threshold).collect()), key=str)


def vectors(seed, n, width, noise):
    random.seed(seed)
    centers = [[random.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    out = []
    for i in range(n):
        base = random.choice(centers)
        out.append((i, [x + random.gauss(0, noise) for x in base]))
    return out


ODD = [(900, None), (901, []), (902, [0.0] * 8), (903, [float("nan")] * 8), (904, [None] * 8), (None, [1.0] * 8),
       (905, [float("inf")] * 8), (906, [1.0] * 5), (907, [1e200] * 8), (908, [1e-200] * 8), (909, [1.0] * 8), (910, [-1.0] * 8)]


@pytest.mark.parametrize("noise", [0.2, 0.45, 2.0])
def test_equals_brute_force(spark, noise):
    rows = vectors(1, 90, 8, noise) + ODD
    rows += [(950, rows[4][1]), (951, rows[4][1])]
    assert run(spark, rows) == by_hand(rows, 0.9)


def test_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "STRIP", 5)
    rows = vectors(2, 150, 12, 0.4)
    assert run(spark, rows) == by_hand(rows, 0.9)


def test_without_the_dense_way(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "DENSE", 2.0)
    rows = vectors(3, 80, 10, 0.35)
    assert run(spark, rows) == by_hand(rows, 0.9)


def test_empty_and_single(spark):
    assert run(spark, []) == []
    assert run(spark, [(4, [1.0, 2.0])]) == [(4, 0, 4, True)]
    assert run(spark, [(4, None)]) == [(4, 0, 4, True)]


def test_labels_of_large_ids_reach_the_smallest():
    class Ids:
        def __init__(self, *ids):
            self.ids = np.array(ids, np.int64)

    x = 1 << 62
    a, b = Ids(x + 1, x + 9), Ids(x + 10, x + 2)  # links a1-b1, a2-b1, a2-b2
    ids, labels = embedding_dedup._labels(a, b, np.array([0, 1, 1]), np.array([0, 0, 1]))
    assert sorted(ids.tolist()) == [x + 1, x + 2, x + 9, x + 10]
    assert labels.tolist() == [x + 1] * 4


def test_single_precision_and_repeated_vectors(spark):
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v])
              for i, v in vectors(4, 120, 8, 0.4) + ODD[:7] + ODD[10:]]
    single += [(1000 + k, single[k // 3][1]) for k in range(60)] + [(1100, [0.0, -0.0, 3.0]), (1101, [-0.0, 0.0, 3.0])]
    frame = spark.createDataFrame(single, "vec_id long, embedding array<float>")
    found = sorted((tuple(r) for r in embedding_dedup.near_duplicates(frame).collect()), key=str)
    assert found == by_hand(single, 0.9)


@pytest.mark.parametrize("n", [30, 150])
def test_a_crowded_stretch_is_cut(spark, monkeypatch, n):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "SLAB", 4096)
    random.seed(5)
    rows = [(i, [1.0 + random.random() / 1e7, float(i % 2), 2.0 * (i % 3)]) for i in range(n)]
    assert run(spark, rows) == by_hand(rows, 0.9)


def test_blocks_are_compared_without_a_shuffle(spark, monkeypatch):
    plans, stored = {}, embedding_dedup.stored

    def noted(frame, label, *more):
        plans[label] = frame._jdf.queryExecution().executedPlan().toString()
        return stored(frame, label, *more)

    monkeypatch.setattr(embedding_dedup, "stored", noted)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rows = vectors(6, 100, 6, 0.4)
    assert run(spark, rows) == by_hand(rows, 0.9)
    assert "CartesianProduct" in plans["tiles"] and "Exchange" not in plans["tiles"]


def test_stretches_have_bounded_blocks(monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 10)
    starts, first, parts = embedding_dedup._stretches(np.array([0, 3, 7, 1, 0, 25, 4, 0, 6, 1]))
    assert (starts.tolist(), first.tolist(), parts.tolist()) == ([0, 3, 5, 6, 9], [0, 1, 2, 5, 6], [1, 1, 3, 1, 1])


def test_sums_keep_counts_and_connections(monkeypatch):
    monkeypatch.setattr(embedding_dedup, "HELD", 8)
    sums = embedding_dedup.Sums()
    parts = [([1, 9, 5], [1, 9, 2], [3, 4, 0]), ([5, 1, 9], [7, 1, 8], [0, 2, 0]), ([8, 7, 20], [7, 2, 20], [0, 0, 5])]
    assert [sums.add([np.array(x, np.int64) for x in part]) for part in parts] == [False, False, True]
    rows = list(zip(*(column.to_pylist() for column in sums.take().columns)))
    assert sorted(rows) == [(1, 1, 5), (5, 2, 0), (7, 2, 0), (8, 2, 0), (9, 2, 0), (9, 9, 4), (20, 20, 5)]
    assert sums.parts == []


def test_links_are_the_same_for_any_lead():
    from types import SimpleNamespace

    random.seed(7)
    rows = np.array([v for _, v in vectors(7, 60, 8, 0.45)])
    n, ones = len(rows), np.ones(len(rows), np.int64).tobytes()
    row = SimpleNamespace(n=n, width=8, matrix=rows.tobytes(), vec_id=np.arange(n).tobytes(), copies=ones, dims=ones)
    steps = [2, 4, 6, 8]
    side = embedding_dedup.Side(row, np.linalg.qr(np.random.default_rng(1).normal(size=(8, 8)))[0], steps)
    found = [
        [x.tolist() for x in embedding_dedup.compare(side, side, True, 0.9, steps, lead)] for lead in steps
    ]
    assert found[0][0] and all(x == found[0] for x in found)
    assert embedding_dedup.best_lead(side, side, 0.9, steps) in steps
