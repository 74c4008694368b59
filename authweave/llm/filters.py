"""Filters of fixed size for 64-bit names: no name that was put in is ruled out."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 26  # 8 MB, whatever the number of names; a fuller filter rules out fewer others


def _bits(names: np.ndarray, size: int) -> list[np.ndarray]:
    names, last = names.view(np.uint64), np.uint64(size - 1)
    return [names & last, (names >> np.uint64(32)) & last]


def _place(bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)


def put(words: np.ndarray, names: np.ndarray) -> None:
    for bit in _bits(names, len(words) * 64):
        word, shift = _place(bit)
        np.bitwise_or.at(words, word, np.uint64(1) << shift)


def held(words: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which names may have been put in."""
    out = np.ones(len(names), bool)
    for bit in _bits(names, len(words) * 64):
        word, shift = _place(bit)
        out &= (words[word] >> shift) & np.uint64(1) == 1
    return out


def filter_of(names: DataFrame, column: str) -> np.ndarray:
    """The filter of a column of longs, put together by words: at most MOST_BITS come to the driver."""
    size = min(MOST_BITS, 1 << max(16, int(16 * names.count()).bit_length()))

    def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = np.zeros(size // 64, np.uint64)
        for frame in frames:
            put(words, frame[column].to_numpy(np.int64))
        some = np.flatnonzero(words)
        yield pd.DataFrame({"place": some, "word": words[some].view(np.int64)})

    found = (
        names.select(column).mapInPandas(part, "place long, word long").groupBy("place")
        .agg(F.bit_or("word").alias("word")).toPandas()
    )
    words = np.zeros(size // 64, np.int64)
    words[found["place"].to_numpy(np.int64)] = found["word"].to_numpy(np.int64)
    return words.view(np.uint64)
