"""Exact top-k by inner product over an impact-ordered index, score at a time."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from authweave.llm.tables import stored
from authweave.llm.vectors import blocks, matrix, usable
from authweave.operators.ids import number_rows

ROWS = 4096  # vectors of an index block
SLAB = 4  # index blocks one task searches after another
QUERIES = 4096  # queries one task carries through its blocks
BATCH = 256  # of them that have accumulators at a time
LEVELS = 8  # quantised impacts
RESCORED = 0.02  # share of a block's rows that may be open when they are scored exactly
PROOF = 0.15  # share of a norm that unprocessed components may have when a proof is first tried
FOUND = "query_id long, vec_id long, score long"


def exact_type(a: np.ndarray, b: np.ndarray):
    """A type in which every partial sum of products of rows of `a` and `b` is exact."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    return np.float32 if largest < 2 ** 24 else np.float64 if largest < 2 ** 53 else object


class Postings:
    """A block's index: a segment per impact level and dimension lists rows and their values.

    Levels are the quantised sizes of components, the largest first; zeros have no posting.
    `rest[k]` is the norm of each row's components that are in levels after k. The rows
    themselves are kept for exact scores. Built once per block, and stored.
    """

    PARTS = ("starts", "row", "value", "rest", "matrix")

    def __init__(self, starts: np.ndarray, row: np.ndarray, value: np.ndarray, rest: np.ndarray, matrix: np.ndarray):
        self.starts, self.row, self.value, self.rest, self.matrix = starts, row, value, rest, matrix
        self.largest = float(np.abs(matrix).max(initial=0))
        self.norm = np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1))

    @classmethod
    def of(cls, matrix: np.ndarray) -> "Postings":
        n, width = matrix.shape
        size = np.abs(matrix).astype(np.float64)
        cuts = np.quantile(size, [1 - (k + 1) / LEVELS for k in range(LEVELS - 1)]) if size.size else []
        level = np.searchsorted(-np.array(cuts), -size, side="left")
        segment = (level * width + np.arange(width)).ravel()
        some = np.flatnonzero(matrix.ravel())
        order = some[np.argsort(segment[some], kind="stable")]
        starts = np.searchsorted(segment[order], np.arange(LEVELS * width + 1))
        squares = size * size
        rest = np.stack([np.sqrt(np.where(level > k, squares, 0).sum(axis=1)) for k in range(LEVELS)])
        return cls(starts, (order // max(width, 1)).astype(np.int32), matrix.ravel()[order], rest, matrix)

    def packed(self) -> dict[str, bytes]:
        return {name: getattr(self, name).tobytes() for name in self.PARTS}

    @classmethod
    def unpacked(cls, row) -> "Postings":
        kind = f"<i{row.bytes}"
        return cls(
            np.frombuffer(row.starts, np.int64), np.frombuffer(row.row, np.int32), np.frombuffer(row.value, kind),
            np.frombuffer(row.rest, np.float64).reshape(LEVELS, row.n),
            np.frombuffer(row.matrix, kind).reshape(row.n, row.width),
        )

    def add(self, level: int, asked: np.ndarray, total: np.ndarray) -> None:
        """Adds the level's segments, one dimension after another, to accumulators by row."""
        width = self.matrix.shape[1]
        for dimension in range(min(width, asked.shape[1])):
            start, stop = self.starts[level * width + dimension:level * width + dimension + 2]
            if start < stop:
                weights = asked[:, dimension]
                total[self.row[start:stop]] += self.value[start:stop, None].astype(total.dtype) * weights


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; the smallest value where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, -k].astype(np.float64)


def search_block(
    queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`search_postings` over rows without an index."""
    return search_postings(queries, own, Postings.of(rows), ids, k, floor)[:3]


def search_postings(
    queries: np.ndarray, own: np.ndarray, index: Postings, ids: np.ndarray, k: int, floor: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of all rows that can be among a query's k best of this block, and the
    levels that each query needed.

    `floor` is a score that k rows of other blocks are known to reach; a query whose product of
    norms with every row is below it needs no level. Accumulators take the segments by
    falling impact. A row's score is at most its accumulator plus the product of the query's norm
    and the norm of the row's unprocessed components; a query's k-th best exact score among its
    leaders is a proof against all rows whose bound is below it. A query ends when the rows
    without such proof are few, or when the segments end; these are scored exactly.
    """
    width = index.matrix.shape[1]
    asked = np.zeros((len(queries), width), queries.dtype)
    asked[:, :min(width, queries.shape[1])] = queries[:, :width]
    norm = np.sqrt((asked.astype(np.float64) ** 2).sum(axis=1))
    levels = np.zeros(len(queries), np.int64)
    reach = norm * index.norm.max(initial=0.0)
    hopeful = np.flatnonzero(reach * (1 + 1e-9) + 1e-6 >= floor)
    found = [
        _search_batch(asked, norm, own, index, ids, k, floor, hopeful[at:at + BATCH], levels)
        for at in range(0, len(hopeful), BATCH)
    ]
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, levels
    q, r, scores = (np.concatenate([part[c] for part in found]) for c in range(3))
    return q, r, scores, levels


def _search_batch(asked, norm, own, index, ids, k, floor, active, levels) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    dtype = exact_type(asked[active], index.matrix)
    weights, floor = asked[active].astype(dtype), floor[active]
    total = np.zeros((len(index.matrix), len(active)), dtype)
    found_q, found_r = [], []
    for level in range(LEVELS):
        index.add(level, weights, total)
        levels[active] += 1
        rest = index.rest[level]
        ended = level == LEVELS - 1 or not rest.any()  # nothing is left: accumulators are scores
        if not ended and rest.max() > PROOF * index.norm.max():
            continue
        mine = own[active][:, None] == ids[None, :]
        seen = np.where(mine, -np.inf, total.T.astype(np.float64 if dtype is object else dtype))
        if not ended and len(ids) >= k:  # exact scores of the leaders so far
            lead = np.argpartition(seen, len(ids) - k, axis=1)[:, -k:]
            exact = np.einsum("qd,qkd->qk", asked[active].astype(np.float64), index.matrix[lead].astype(np.float64))
            exact[np.take_along_axis(mine, lead, axis=1)] = -np.inf
            floor = np.maximum(floor, exact.min(axis=1))
        elif ended:
            floor = np.maximum(floor, _kth(seen, k))
        margin = 0.0 if ended else norm[active][:, None] * rest + 1e-6 * (1 + norm[active][:, None] * rest)
        # scores of 2^53 and more are compared by whole doubles: leave room for rounding
        room = 0.0 if dtype is not object else np.abs(floor) * 1e-9 + 1
        open_rows = (seen + margin >= (floor - room)[:, None]) & ~mine
        done = open_rows.sum(axis=1) <= RESCORED * len(ids)
        if ended:
            done[:] = True
        q, r = np.nonzero(open_rows & done[:, None])
        found_q.append(active[q])
        found_r.append(r)
        if done.all():
            break
        if done.any():
            active, weights, floor, total = active[~done], weights[~done], floor[~done], total[:, ~done]
    q, r = np.concatenate(found_q), np.concatenate(found_r)
    if dtype is object:
        scores = np.array([int(np.dot(asked[a].astype(object), index.matrix[b].astype(object)))
                           for a, b in zip(q, r, strict=True)], dtype=object)
    else:
        scores = np.empty(len(q), np.int64)
        for start in range(0, len(q), 50_000):
            part = slice(start, start + 50_000)
            scores[part] = (asked[q[part]].astype(np.int64) * index.matrix[r[part]].astype(np.int64)).sum(axis=1)
    return q, r, scores


def best(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each query: highest score, then smallest id."""
    order = np.lexsort((ids, -scores if scores.dtype != object else [-s for s in scores], q))
    sorted_q = q[order]
    starts = np.r_[0, np.flatnonzero(np.diff(sorted_q)) + 1] if len(q) else np.zeros(0, int)
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
    return order[rank < k]


def quantised(vector, scale: int = 64):
    """floor(scale * x) of each component, as long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def top_k(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of the highest inner product for each query.

    Both tables have vec_id (long) and vector (array of long). Rows with a query's id are
    not its candidates. Ties go to the smaller id; a query with fewer candidates gets all.
    Rows equal in id and vector count once; shorter vectors count as filled up with zeros;
    rows without an id take no part, nor do other columns, whatever their names; an empty table
    on either side gives no rows.

    Index blocks hold vectors of similar norms, and their postings are built once and stored.
    Blocks of queries meet slabs of index blocks in one shuffle; a slab has large and small norms
    and is searched from the largest on, so that later blocks start with a high floor. Each slab
    returns at most k rows per query, which a ranked window merges. Nothing is returned before the
    scores of all other rows are proven to be too low.
    """
    rows = stored(rows.where("vec_id is not null").select("vec_id", "vector").distinct(), "rows")
    queries = stored(queries.where("vec_id is not null").select("vec_id", "vector").distinct(), "asked")
    asked_parts = max(1, -(-queries.count() // QUERIES))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    numbered = number_rows(rows.withColumn("size", square), [F.desc("size"), "vec_id"], "number", 0)
    parts = max(1, -(-rows.count() // ROWS))
    slabs = -(-parts // SLAB)
    widest = rows.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0] or 0
    kind = next(b for b in (1, 2, 4, 8) if b == 8 or widest < 1 << 8 * b - 1)

    def index_block(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                made = Postings.of(matrix(row, f"<i{kind}", row.width))
                yield pd.DataFrame([{
                    "block": row.block, "n": row.n, "width": row.width, "bytes": kind, "vec_id": row.vec_id, **made.packed(),
                }])

    parted = blocks(
        numbered.withColumn("at", F.expr(f"number div {ROWS}")), "at", "vec_id", "vector", [], f"<i{kind}"
    )
    columns = "block long, n long, width long, bytes long, vec_id binary, " + ", ".join(
        f"{name} binary" for name in Postings.PARTS
    )
    index = stored(parted.mapInPandas(index_block, columns), "index")
    place = F.pmod(F.xxhash64("vec_id"), F.lit(asked_parts))
    asked = stored(blocks(queries.withColumn("at", place), "at", "vec_id", "vector", [], "<i8"), "asked")
    left = asked.withColumnRenamed("block", "part").withColumn(
        "slab", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1)).cast("array<long>"))
    )
    right = index.withColumn("slab", F.pmod("block", F.lit(slabs))).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(asked_parts - 1)).cast("array<long>"))
    )

    def search(some: pd.DataFrame, slab: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)
        if not len(some) or not len(slab):
            return empty
        row = next(some.itertuples())
        vectors, own = matrix(row, "<i8", row.width), np.frombuffer(row.vec_id, np.int64)
        q, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        scores, floor = np.zeros(0, np.int64), np.full(len(own), -np.inf)
        for block in slab.sort_values("block").itertuples():
            held, names = Postings.unpacked(block), np.frombuffer(block.vec_id, np.int64)
            more_q, more_r, more, _ = search_postings(vectors, own, held, names, k, floor)
            q, ids = np.concatenate([q, more_q]), np.concatenate([ids, names[more_r]])
            scores = np.concatenate([scores, more])
            kept = best(q, ids, scores, k)
            q, ids, scores = q[kept], ids[kept], scores[kept]
            full = np.bincount(q, minlength=len(own)) >= k
            last = np.full(len(own), np.inf)
            np.minimum.at(last, q, scores.astype(np.float64))
            floor = np.maximum(floor, np.where(full, last, -np.inf))
        return pd.DataFrame({"query_id": own[q], "vec_id": ids, "score": scores.astype(np.int64)})

    found = left.groupBy("part", "slab").cogroup(right.groupBy("part", "slab")).applyInPandas(search, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def top_k_quantised(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """`top_k` of the rows whose id is divisible by `every`, over the table itself.

    Null vectors and those with null or non-finite components take no part.
    """
    rows = vectors.where(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding"), scale).alias("vector")
    )
    return top_k(rows, rows.where(F.pmod("vec_id", F.lit(every)) == 0), k)
