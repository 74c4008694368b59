import math
import random

import numpy as np
import pytest
from authweave.llm import topk
from authweave.llm.tables import table


def by_hand(rows, k, every):
    kept = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in {i for i, _ in kept if i % every == 0}:
        found = []
        for i, v in kept:
            if i != q:
                for j, w in kept:
                    if j == q:
                        found.append((-sum(a * b for a, b in zip(v, w)), i))
        for rank, (score, i) in enumerate(sorted(found)[:k], 1):
            out.add((q, rank, i, -score))
    return out


def run(spark, rows, k, every):
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    found = [tuple(r) for r in topk.top_k_quantised(frame, k, every).collect()]
    assert len(found) == len(set(found))
    return set(found)


def vectors(seed, n, width, scale=0.2):
    random.seed(seed)
    return [(i, [random.gauss(0, scale) for _ in range(width)]) for i in range(n)]


ODD = [(500, None), (520, [None] * 8), (540, [float("nan")] * 8), (560, [float("inf")] + [0.0] * 7), (None, [0.1] * 8),
       (580, [0.0] * 8), (600, []), (620, [1.0])]


def test_equals_brute_force(spark):
    rows = vectors(1, 120, 8) + ODD
    rows += [(700, rows[3][1]), (701, rows[3][1]), (3, rows[3][1])]
    assert run(spark, rows, 5, 20) == by_hand(rows, 5, 20)


@pytest.mark.parametrize("scale", [0.01, 1e4, 1e6])
def test_sizes_of_numbers(spark, scale):
    rows = vectors(2, 60, 6, scale)
    assert run(spark, rows, 4, 7) == by_hand(rows, 4, 7)


def test_many_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 9)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rows = vectors(3, 150, 8)
    assert run(spark, rows, 6, 5) == by_hand(rows, 6, 5)


def test_ties_and_fewer_rows_than_k(spark):
    rows = [(i, [1.0, 1.0]) for i in range(12)]
    assert run(spark, rows, 5, 6) == by_hand(rows, 5, 6)
    assert run(spark, rows[:3], 5, 2) == by_hand(rows[:3], 5, 2)
    assert run(spark, rows[:1], 5, 1) == set() and run(spark, [], 5, 1) == set()


def test_bounds_leave_rows_unscored():
    rng = np.random.default_rng(0)
    centers = rng.normal(0, 12, (8, 32))
    rows = np.rint(centers[rng.integers(0, 8, 3000)] + rng.normal(0, 3, (3000, 32))).astype(np.int64)
    queries = rows[:20]
    q, r, scores = topk.search_block(queries, np.arange(20), rows, np.arange(3000), 10, np.full(20, -np.inf))
    assert len(q) < 0.5 * 20 * 3000
    exact = queries @ rows.T
    for k in range(20):
        exact[k, k] = -10 ** 9
        tenth = np.sort(exact[k])[-10]
        assert set(np.flatnonzero(exact[k] >= tenth)) <= set(r[q == k])
    assert (scores == (queries @ rows.T)[q, r]).all()


def test_postings_hold_each_component_once():
    rng = np.random.default_rng(1)
    rows = np.rint(rng.normal(0, 9, (50, 7))).astype(np.int64)
    index = topk.Postings.of(rows)
    assert len(index.row) == np.count_nonzero(rows)
    back, sizes = np.zeros_like(rows), []
    for level in range(topk.LEVELS):
        here = []
        for d in range(7):
            start, stop = index.starts[level * 7 + d:level * 7 + d + 2]
            back[index.row[start:stop], d] += index.value[start:stop]
            here += np.abs(index.value[start:stop]).tolist()
        sizes.append(here)
        left = np.sqrt(((rows - back) ** 2).sum(axis=1))
        assert np.allclose(left, index.rest[level])
    assert (back == rows).all()
    some = [s for s in sizes if s]
    assert all(min(a) >= max(b) for a, b in zip(some, some[1:]))


def test_queries_of_the_test_table_end_before_the_last_level(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings").collect()
    kept = [r for r in vectors if r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding)]
    rows = np.floor(64 * np.array([r.embedding for r in kept])).astype(np.int64)
    ids = np.array([r.vec_id for r in kept])
    asked = ids % 20 == 0
    q, r, scores, levels = topk.search_postings(
        rows[asked], ids[asked], topk.Postings.of(rows), ids, 20, np.full(asked.sum(), -np.inf)
    )
    assert (levels < topk.LEVELS).mean() > 0.9 and len(q) < 0.02 * asked.sum() * len(ids) * 1.01
    known = np.full(asked.sum(), 1e9)  # other blocks hold better rows for certain
    assert not topk.search_postings(rows[asked], ids[asked], topk.Postings.of(rows), ids, 20, known)[3].any()


def test_clashing_names_and_empty_sides(spark):
    rows = spark.createDataFrame(
        [(k, [k, 1], k, "x", 0.5) for k in range(6)],
        "vec_id long, vector array<long>, size int, number string, block double",
    )
    found = {tuple(r) for r in topk.top_k(rows, rows.where("vec_id = 2"), 2).collect()}
    assert found == {(2, 1, 5, 11), (2, 2, 4, 9)}
    assert topk.top_k(rows.limit(0), rows, 2).count() == topk.top_k(rows, rows.limit(0), 2).count() == 0
