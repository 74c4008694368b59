"""URL lists: a blocked Bloom filter passes possible hits to an exact hash join."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

WORDS = 8  # 64-bit words of a block; each key sets one bit in each of them
MAX_BLOCKS = 1 << 15  # 2 MB of filter, whatever the list's size; the join makes results exact
_ODD = np.array(  # fixed values: odd multipliers that pick the bit within each word
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
     0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB, 0xBF58476D1CE4E5B9],
    dtype=np.uint64,
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first :// and the next / ? # or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ? # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def _blocks_and_bits(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    keys = keys.view(np.uint64)
    block = (keys >> np.uint64(40)) & np.uint64(blocks - 1)
    low = (keys & np.uint64(0xFFFFFFFF)) | np.uint64(1 << 33)
    bits = np.uint64(1) << ((low[:, None] * _ODD[None, :]) >> np.uint64(58))
    return block.astype(np.int64), bits


def _filter_of(listed: DataFrame) -> np.ndarray:
    """Blocks of the listed keys: ORed within tasks, then across; at most MAX_BLOCKS rows."""
    wanted = max(listed.count(), 1) * 16 // (64 * WORDS) + 1
    blocks = min(MAX_BLOCKS, 1 << (wanted - 1).bit_length())
    words = [f"w{k}" for k in range(WORDS)]

    def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros((blocks, WORDS), np.uint64)
        for frame in frames:
            block, mask = _blocks_and_bits(frame["key"].to_numpy(np.int64), blocks)
            np.bitwise_or.at(bits, block, mask)
        used = np.flatnonzero(bits.any(axis=1))
        out = pd.DataFrame(bits[used].view(np.int64), columns=words)
        out.insert(0, "block", used)
        yield out

    schema = "block long, " + ", ".join(f"{w} long" for w in words)
    rows = (
        listed.select("key").mapInPandas(part, schema).groupBy("block")
        .agg(*[F.bit_or(w).alias(w) for w in words]).collect()
    )
    bits = np.zeros((blocks, WORDS), np.int64)
    for row in rows:
        bits[row.block] = [row[w] for w in words]
    return bits.view(np.uint64)


def _possible(bits: np.ndarray):
    """Keeps the keys of each row that the filter does not rule out."""

    @pandas_udf("array<long>")
    def possible(keys: pd.Series) -> pd.Series:
        sizes = keys.map(len).to_numpy()
        if not sizes.sum():
            return keys
        flat = np.concatenate(keys.to_list()).astype(np.int64)
        block, mask = _blocks_and_bits(flat, len(bits))
        hit = ((bits[block] & mask) == mask).all(axis=1)
        ends = np.cumsum(sizes)
        return pd.Series([flat[e - s:e][hit[e - s:e]] for s, e in zip(sizes, ends, strict=True)])

    return possible


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict to each row.

    `rules` has host, path, verdict: canonical URL prefixes. A rule fits its host and the
    host's subdomains where the path starts with the rule's. The longest rule wins; of
    equally long ones that of the longer host, then block before allow. Rows that no rule
    fits get a null rule and `default`: what is not listed is allowed.

    The list's distinct shapes (labels of the host, length of the path) give each URL its few
    possible keys. The filter has a fixed size, so it is sent to all tasks; only keys it lets
    pass are joined with the list, once per distinct host and path. The pages themselves are
    joined on (host, path), where adaptive execution splits a hot one; rows without a
    possible hit are not moved. Null URLs and URLs without :// have empty host and path and
    fit no rule; rules without a host fit nothing; repeated rows stay repeated; columns of
    the input named host, path, rule or verdict are replaced. An empty list allows all.
    """
    listed = (
        rules.where("host is not null and host != '' and path is not null")
        .select("host", "path", "verdict").distinct()
        .select(
            F.xxhash64("host", "path").alias("key"), F.col("host").alias("r_host"),
            F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"),
            _labels(F.col("host")).alias("k"), F.length("path").alias("n"),
        )
    )
    shapes = sorted((row.k, row.n) for row in listed.select("k", "n").distinct().collect())
    rows = pages.drop("host", "path", "rule", "verdict").withColumns(
        {"host": host_of(F.col(url)), "path": path_of(F.col(url))}
    )
    if not shapes:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    as_array = F.split(F.lit(" ".join(f"{k},{n}" for k, n in shapes)), " ")
    shape_k = lambda s: F.split_part(s, F.lit(","), F.lit(1)).cast("int")
    shape_n = lambda s: F.split_part(s, F.lit(","), F.lit(2)).cast("int")
    fitting = F.filter(
        as_array,
        lambda s: (shape_k(s) <= _labels(F.col("host"))) & (shape_n(s) <= F.length("path")),
    )
    keys = F.transform(
        fitting,
        lambda s: F.xxhash64(
            F.call_function("substring_index", F.col("host"), F.lit("."), -shape_k(s)),
            F.call_function("left", F.col("path"), shape_n(s)),
        ),
    )
    probed = rows.withColumn("_keys", _possible(_filter_of(listed))(keys))
    hits = probed.where(F.size("_keys") > 0)
    exact = (
        hits.select("host", "path", "_keys").distinct()
        .select("host", "path", F.explode("_keys").alias("key"))
        .join(listed, "key")
        .where(
            (F.expr("substring_index(host, '.', -k)") == F.col("r_host"))
            & F.startswith("path", "r_path")
        )
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    (F.length("r_host") + F.length("r_path")).alias("size"),
                    F.length("r_host").alias("host_size"),
                    (F.col("r_verdict") == "block").alias("blocks"),
                    F.concat("r_host", "r_path").alias("rule"),
                    F.col("r_verdict").alias("verdict"),
                )
            ).alias("best")
        )
        .select("host", "path", "best.rule", "best.verdict")
    )
    judged = hits.drop("_keys").join(exact, ["host", "path"], "left")
    missed = probed.where(F.size("_keys") == 0).drop("_keys")
    missed = missed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    return judged.unionByName(missed).withColumn("verdict", F.coalesce("verdict", F.lit(default)))
