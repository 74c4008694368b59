"""Near-duplicate vectors: tiles in PCA order, pruned by the norms of what is left."""

from bisect import bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from functools import cached_property
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authweave.llm.components import components
from authweave.llm.tables import again, brief_shuffles, forget, lean, small_reads, stored
from authweave.llm.vectors import blocks, matrix, usable

BLOCK = 4096  # vectors of a block; a tile compares two blocks
SLAB = 16 << 20  # bytes of the blocks in a file; a task compares the blocks of two scans of so much
STRIP = 256  # rows of a tile that are compared at once
STEPS = 4  # parts of the dimensions, in the order of their variance
SLACK = 1e-5  # more than the rounding of single precision on unit vectors
DENSE = 0.05  # share of surviving pairs from which a strip is multiplied as a whole
ONE = 7500  # a surviving pair takes the time of so many products within a strip
BINS = 1 << 16  # of the leading coordinate, whose counts come to the driver
HELD = 1 << 18  # links of a tile, and rows of results of a task, that are gathered before they are summed up
FOUND = "id long, other long, n long"


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by the largest component first so that no square overflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def principal_axes(distinct: DataFrame, width: int) -> np.ndarray:
    """Orthonormal axes (columns) of the unit vectors, by falling second moment.

    Tasks add up outer products; a row of the moments is one group. Only the width x width
    matrix comes to the driver.
    """

    def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for frame in frames:
            for start in range(0, len(frame), 2048):
                unit = _unit(_padded(frame["embedding"].iloc[start:start + 2048], width))
                total += unit.T @ unit
        yield pd.DataFrame({"k": np.arange(width), "values": list(total)})

    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": [key[0]], "values": [np.sum(np.stack(frame["values"]), axis=0)]})

    schema = "k long, values array<double>"
    rows = (
        distinct.select("embedding").mapInPandas(part, schema)
        .groupBy("k").applyInPandas(add, schema).collect()
    )
    moments = np.zeros((width, width))
    for row in rows:
        moments[row.k] = row["values"]
    _, axes = np.linalg.eigh((moments + moments.T) / 2)
    return np.ascontiguousarray(axes[:, ::-1])


def _padded(vectors: pd.Series, width: int) -> np.ndarray:
    if len(vectors) and all(len(values) == width for values in vectors):
        return np.concatenate(list(vectors)).reshape(-1, width).astype(np.float64)
    out = np.zeros((len(vectors), width))
    for k, values in enumerate(vectors):
        out[k, :len(values)] = values
    return out


class Side:
    """One block as a tile needs it."""

    def __init__(self, row, axes: np.ndarray, steps: list[int], dtype: str = "<f8"):
        self.raw = matrix(row, dtype, len(axes))
        self.ids = np.frombuffer(row.vec_id, np.int64)
        self.copies = np.frombuffer(row.copies, np.int64)
        self.sizes = np.frombuffer(row.dims, np.int64)
        exact = self.raw.astype(np.float64)
        with np.errstate(over="ignore"):
            self.norm = np.sqrt((exact * exact).sum(axis=1))
        self.odd = (self.norm > 1e150) | (self.norm < 1e-150)  # squares near the ends of the range of doubles
        self.turned = _unit(exact) @ axes
        squares = np.cumsum((self.turned * self.turned)[:, ::-1], axis=1)[:, ::-1]
        left = np.concatenate([squares, np.zeros((len(squares), 1))], axis=1)
        self.rest = {k: np.sqrt(np.maximum(left[:, k], 0)) for k in steps}
        self._leads = {}

    @cached_property
    def unit(self) -> np.ndarray:
        return _unit(self.raw.astype(np.float64))

    def lead(self, step: int) -> np.ndarray:
        """Leading coordinates, then the norm of the others: products of two such rows
        bound the cosine from above."""
        if step not in self._leads:
            self._leads[step] = np.concatenate(
                [self.turned[:, :step], self.rest[step][:, None]], axis=1
            ).astype(np.float32)
        return self._leads[step]


def _cosine(a: Side, b: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i))
    for start in range(0, len(i), 20_000):
        part = slice(start, start + 20_000)
        left, right = a.raw[i[part]].astype(np.float64), b.raw[j[part]].astype(np.float64)
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            out[part] = (left * right).sum(axis=1) / (a.norm[i[part]] * b.norm[j[part]])
    wide = ~np.isfinite(out) | a.odd[i] | b.odd[j]
    if wide.any():
        out[wide] = (a.unit[i[wide]] * b.unit[j[wide]]).sum(axis=1)
    return out


def best_lead(a: Side, b: Side, threshold: float, steps: list[int]) -> int:
    """The number of leading coordinates that takes the least time: with fewer, products are
    cheaper and more pairs survive them. Some pairs of the tile show how many; whatever the
    number, the links are the same."""
    some = [np.linspace(0, len(side.ids) - 1, min(256, len(side.ids))).astype(int) for side in (a, b)]

    def cost(step: int) -> float:
        bound = a.lead(step)[some[0]] @ b.lead(step)[some[1]].T
        return step + ONE * np.count_nonzero(bound >= threshold - SLACK) / bound.size

    return min(steps, key=cost)


def links(
    a: Side, b: Side, strip: slice, threshold: float, steps: list[int], lead: int, room: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of the pairs of a strip of `a` with `b` that reach the threshold.

    `room` is overwritten: an array of singles and one of booleans as large as a strip.
    """
    bound, near = (x[:strip.stop - strip.start] for x in room)
    np.matmul(a.lead(lead)[strip], b.lead(lead).T, out=bound)
    np.greater_equal(bound, threshold - SLACK, out=near)
    if not near.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if np.count_nonzero(near) > DENSE * near.size:
        product = a.unit[strip] @ b.unit.T
        i, j = np.nonzero(product >= threshold - 1e-9)
        i += strip.start
        near = np.abs(product[i - strip.start, j] - threshold) < 1e-9
        keep = ~near
        keep[near] = _cosine(a, b, i[near], j[near]) >= threshold
        return i[keep], j[keep]
    rows = np.flatnonzero(near.any(axis=1))
    i, j = np.nonzero(near[rows])
    i = rows[i] + strip.start
    total, done = np.zeros(len(i)), 0
    for step in steps:
        for start in range(0, len(i), 50_000):
            part = slice(start, start + 50_000)
            total[part] += (a.turned[i[part], done:step] * b.turned[j[part], done:step]).sum(axis=1)
        keep = total + a.rest[step][i] * b.rest[step][j] >= threshold - 1e-9
        i, j, total, done = i[keep], j[keep], total[keep], step
    keep = _cosine(a, b, i, j) >= threshold
    return i[keep], j[keep]


def _labels(a: Side, b: Side, i: np.ndarray, j: np.ndarray) -> list[np.ndarray]:
    """(id, other): a star around the smallest id of each component of the links."""
    of_a, of_b = a.ids.copy(), b.ids.copy()
    while len(i):
        before_a, before_b = of_a.copy(), of_b.copy()
        np.minimum.at(of_a, i, of_b[j])
        np.minimum.at(of_b, j, of_a[i])
        if np.array_equal(of_a, before_a) and np.array_equal(of_b, before_b):
            break
    rows, columns = np.unique(i), np.unique(j)
    return [
        np.concatenate([a.ids[rows], b.ids[columns]]),
        np.concatenate([of_a[rows], of_b[columns]]),
    ]


def compare(a: Side, b: Side, same: bool, threshold: float, steps: list[int], lead: int) -> list[np.ndarray]:
    """Columns of FOUND: numbers of links of each vector of the tile, and stars, with n = 0, that
    connect what is linked."""
    count_a, count_b, stars = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64), []
    open_i, open_j = [], []
    room = [np.empty((min(STRIP, len(a.ids)), len(b.ids)), kind) for kind in (np.float32, bool)]
    for start in range(0, len(a.ids), STRIP):
        strip = slice(start, min(start + STRIP, len(a.ids)))
        i, j = links(a, b, strip, threshold, steps, lead, room)
        keep = a.sizes[i] == b.sizes[j]
        if same:
            keep &= i != j
        open_i.append(i[keep])
        open_j.append(j[keep])
        if sum(map(len, open_i)) < HELD and strip.stop < len(a.ids):
            continue
        i, j = np.concatenate(open_i), np.concatenate(open_j)
        open_i, open_j = [], []
        if not len(i):
            continue
        np.add.at(count_a, i, b.copies[j])
        if not same:
            np.add.at(count_b, j, a.copies[i])
        stars.append(_labels(a, b, i, j))
    ids = np.concatenate([a.ids, b.ids])
    counts = np.concatenate([count_a, count_b])
    some = counts > 0
    u, v = (np.concatenate([s[k] for s in stars] or [ids[:0]]) for k in (0, 1))
    pairs = np.unique(np.stack([u, v], axis=1)[u != v], axis=0)
    return [
        np.concatenate([ids[some], pairs[:, 0]]),
        np.concatenate([ids[some], pairs[:, 1]]),
        np.concatenate([counts[some], np.zeros(len(pairs), np.int64)]),
    ]


def summed(ids: np.ndarray, others: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """The same numbers of links and connections, in two rows at most for an id."""
    known, place = np.unique(np.concatenate([ids, others]), return_inverse=True)
    u, v = place[:len(ids)], place[len(ids):]
    counts = np.zeros(len(known), np.int64)
    np.add.at(counts, u, n)
    star = u != v
    u, v, least = u[star], v[star], np.arange(len(known))
    while True:
        before = least.copy()
        np.minimum.at(least, u, least[v])
        np.minimum.at(least, v, least[u])
        least = least[least]
        if np.array_equal(least, before):
            break
    some, moved = np.flatnonzero(counts), np.flatnonzero(least != np.arange(len(known)))
    return [
        np.concatenate([known[some], known[moved]]),
        np.concatenate([known[some], known[least[moved]]]),
        np.concatenate([counts[some], np.zeros(len(moved), np.int64)]),
    ]


class Sums:
    """Results of a task's tiles, summed up whenever there are many."""

    def __init__(self):
        self.parts, self.rows = [], 0

    def add(self, part: list[np.ndarray]) -> bool:
        """Whether so much is left that it should be taken."""
        self.parts.append(part)
        self.rows += len(part[0])
        if self.rows <= HELD:
            return False
        self.parts = [summed(*map(np.concatenate, zip(*self.parts)))]
        self.rows = len(self.parts[0][0])
        return self.rows > HELD // 2

    def take(self) -> pa.RecordBatch:
        columns = summed(*map(np.concatenate, zip(*self.parts)))
        self.parts, self.rows = [], 0
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["id", "other", "n"])


class Sides:
    """The sides a task has met last, as far as their vectors fill two slabs."""

    COLUMNS = ("n", "width", "matrix", "vec_id", "copies", "dims")

    def __init__(self, *args):
        self.args, self.kept = args, OrderedDict()

    def of(self, batch: pa.RecordBatch, k: int, name: str) -> tuple[int, Side]:
        """Number and side of the block in row k, whose columns have the name in front."""
        block = batch.column(f"{name}_block")[k].as_py()
        if block not in self.kept:
            values = {c: batch.column(f"{name}_{c}")[k] for c in self.COLUMNS}
            row = {c: x.as_buffer() if pa.types.is_binary(x.type) else x.as_py() for c, x in values.items()}
            self.kept[block] = Side(SimpleNamespace(**row), *self.args)
        self.kept.move_to_end(block)
        while len(self.kept) > 2 and sum(side.raw.nbytes for side in self.kept.values()) > 2 * SLAB:
            self.kept.popitem(last=False)
        return block, self.kept[block]


def _stretches(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins to stretches of some BLOCK vectors: the first bin of each, the number of its first block,
    and its number of blocks, over 1 where one bin holds more."""
    starts, sizes = [], []
    for at, n in enumerate(counts):
        if not sizes or sizes[-1] + n > BLOCK and sizes[-1]:
            starts.append(at)
            sizes.append(0)
        sizes[-1] += n
    parts = np.maximum(1, -(-np.array(sizes, np.int64) // BLOCK))
    return np.array(starts), np.cumsum(parts) - parts, parts


def _blocked(distinct: DataFrame, axes: np.ndarray, threshold: float, dtype: str) -> DataFrame:
    """Blocks by the leading coordinate, each with the last block that can hold links with it.

    Linked vectors differ by at most sqrt(2 - 2 * threshold) in any coordinate of the unit
    vectors, so blocks further apart are not compared. Crowded stretches of the coordinate
    are cut further by a hash of the vector. The driver sees the number of vectors in each bin.
    """
    lead = axes[:, 0]

    def bins(vectors: pd.Series) -> np.ndarray:
        out = [np.zeros(0, np.int64)]
        for start in range(0, len(vectors), 2048):
            unit = _unit(_padded(vectors.iloc[start:start + 2048], len(lead)))
            out.append(np.floor(((unit * lead).sum(axis=1) + 1) / 2 * BINS).astype(np.int64))
        return np.clip(np.concatenate(out), 0, BINS - 1)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BINS, np.int64)
        for frame in frames:
            total += np.bincount(bins(frame["embedding"]), minlength=BINS)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bin": some, "n": total[some]})

    counts = np.zeros(BINS, np.int64)
    found = distinct.select("embedding").mapInPandas(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    for row in found.collect():
        counts[row.bin] = row.n
    starts, first, parts = _stretches(counts)
    edges = np.append(starts, BINS) * (2 / BINS) - 1
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    lows, highs = np.repeat(edges[:-1], parts), np.repeat(edges[1:], parts)
    reached = np.array([bisect_right(lows, high + reach) - 1 for high in highs])

    @F.pandas_udf("long")
    def block_of(vectors: pd.Series, hashes: pd.Series) -> pd.Series:
        stretch = np.searchsorted(starts, bins(vectors), side="right") - 1
        return pd.Series(first[stretch] + hashes.to_numpy() % parts[stretch])

    @F.pandas_udf("long")
    def last_of(block: pd.Series) -> pd.Series:
        return pd.Series(reached[block.to_numpy()])

    packed = blocks(
        distinct.withColumn("block", block_of("embedding", F.xxhash64("embedding"))),
        "block", "vec_id", "embedding", ["copies", "dims"], dtype,
    )
    size = BLOCK * len(lead) * np.dtype(dtype).itemsize
    file_rows = max(1, min(SLAB // size, len(lows) // 32))
    return stored(packed.withColumn("last", last_of("block")), "blocks", file_rows)


def _compared(packed: DataFrame, axes: np.ndarray, threshold: float, dtype: str) -> DataFrame:
    """FOUND of all tiles. A task reads the blocks of two scans and compares each with each: the blocks
    are stored once and nothing is shuffled, however many tiles a block is in."""
    width = len(axes)
    steps = sorted({max(1, -(-width * k // STEPS)) for k in range(1, STEPS + 1)})

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, sums, lead = Sides(axes, steps, dtype), Sums(), None
        for batch in batches:
            for k in range(batch.num_rows):
                (i, a), (j, b) = sides.of(batch, k, "a"), sides.of(batch, k, "b")
                lead = lead or best_lead(a, b, threshold, steps)
                if sums.add(compare(a, b, i == j, threshold, steps, lead)):
                    yield sums.take()
        if sums.parts:
            yield sums.take()

    def named(frame: DataFrame, name: str) -> DataFrame:
        return frame.select([F.col(c).alias(f"{name}_{c}") for c in frame.columns])

    met = named(packed, "a").hint("shuffle_replicate_nl").join(
        named(again(packed), "b"), F.expr("a_block <= b_block AND b_block <= a_last")
    )
    with small_reads(packed.sparkSession, 2 * SLAB):
        return stored(met.mapInArrow(lean(tiles), FOUND), "tiles")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row; links join vectors of one length
    whose cosine is at least `threshold` (above 0).

    Equal vectors are compared once, with their number; a hot vector is one row before
    anything is compared. All pairs of distinct vectors are decided: a tile multiplies the
    leading principal coordinates and drops pairs whose sum, plus the product of the norms of
    the other coordinates, stays below the threshold; what is left gains further coordinates
    and is at last decided by the cosine of the given vectors. Tiles return counts and stars,
    never pairs.

    Null or zero vectors and those with null or non-finite components have no links and are
    their own component; so have rows without an id, whose component is null and which are
    not kept. Rows that repeat an id are vectors of their own in the counts. An empty
    table gives no rows; other columns are not looked at.
    """
    spark = vectors.sparkSession
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind, dtype = ("array<float>", "<f4") if single else ("array<double>", "<f8")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding")
    )
    able = usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    able &= F.exists(F.col("embedding"), lambda x: x != 0)
    able = F.coalesce(able, F.lit(False))
    alone = rows.where(~able).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
        F.col("vec_id").isNotNull().alias("kept"),
    )
    with brief_shuffles(spark):
        distinct = stored(
            rows.where(able).groupBy("embedding")
            .agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
            .withColumn("dims", F.size("embedding").cast("long")),
            "distinct",
        )
        width = distinct.agg(F.max("dims")).first()[0]
        if width is None:
            return alone
        axes = principal_axes(distinct, width)
        packed = _blocked(distinct, axes, threshold, dtype)
        once = stored(distinct.where("copies = 1").select("vec_id", "copies"), "once")
        repeated = stored(distinct.where("copies > 1").select("vec_id", "copies", "embedding"), "repeated")
        forget(distinct)
        found = _compared(packed, axes, threshold, dtype)
        forget(packed)
        counts = stored(found.groupBy(F.col("id").alias("vec_id")).agg(F.sum("n").alias("n")), "counts")
        reached = components(found.where("id != other"), "id", "other").withColumnRenamed("id", "vec_id")
        forget(found)

    def decided(groups: DataFrame) -> DataFrame:
        return (
            groups.join(again(counts), "vec_id", "left").join(reached, "vec_id", "left")
            .withColumn("n_links", F.coalesce("n", F.lit(0)) + F.col("copies") - 1)
            .withColumn("component_id", F.coalesce("component", "vec_id"))
        )

    linked = decided(once).select("vec_id", "n_links", "component_id").unionByName(
        rows.where(able).join(decided(repeated).drop("vec_id"), "embedding")
        .select("vec_id", "n_links", "component_id")
    )
    return linked.withColumn("kept", F.col("vec_id") == F.col("component_id")).unionByName(alone)
