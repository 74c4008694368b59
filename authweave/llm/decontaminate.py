"""Benchmark passages in documents, found by an Aho-Corasick automaton over words.

Texts are lower-cased (A-Z only) and cut into words of letters, digits and all that is not
ASCII. A window is `size` consecutive words of an item, or a whole shorter item. The windows of
all items make one automaton over word numbers; a document's words run through it once, and
the words of every window that occurs are mapped back to characters of the original text.

A benchmark above `bound` bytes is cut into shares below it, each with an automaton of its own
and a pass over the texts; equal texts are looked up once where their hits are put together.
"""

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authweave.llm.tables import stored
from authweave.operators.ids import running_total

SHARE_BYTES = 1 << 20  # of benchmark words in one automaton, which takes some 150 times as much memory
PIECE_WORDS = 1000  # windows of an item that go together
BLOCK_BYTES = 1 << 20  # of a text whose words are held at a time

#: Bytes of words after lower-casing: 0-9, a-z and every byte of a character that is not ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")

RUNS = "array<struct<first: bigint, until: bigint, start: bigint, stop: bigint>>"
FOUND = f"n_words bigint, runs {RUNS}, items array<string>"
ARROW_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("first", "until", "start", "stop")]))


def _blocks(low: bytes) -> Iterator[tuple[int, int]]:
    """Stretches of some BLOCK_BYTES that no word crosses."""
    start = 0
    while start < len(low):
        gap = GAP.search(low, min(start + BLOCK_BYTES, len(low)))
        stop = gap.start() if gap else len(low)
        yield start, stop
        start = stop


def _pieces(items: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """(item, place, words, cost): windows of each item, cut so that no piece is long."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for item, raw in zip(frame["item"], frame["text"]):
                words = WORD.findall(raw.encode().lower())
                for at in range(0, max(len(words) - size, 0) + 1 if words else 0, PIECE_WORDS):
                    piece = b" ".join(words[at:at + PIECE_WORDS + size - 1]).decode()
                    rows.append((item, at, piece, len(piece.encode()) + 16 * size))
            yield pd.DataFrame(rows, columns=["item", "place", "words", "cost"])

    named = items.where(F.col(text).isNotNull()).select(
        F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")
    )
    return named.distinct().mapInPandas(cut, "item string, place long, words string, cost long")


class Windows:
    """An automaton over the windows of some pieces; words are numbered from 1."""

    def __init__(self, pieces: Iterable[tuple[str | None, str]], size: int):
        self.size, self.numbers, self.owners = size, {}, []
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for item, text in pieces:
            words = [
                self.numbers.setdefault(word, len(self.numbers) + 1) for word in text.encode().split(b" ")
            ]
            for at in range(max(len(words) - size, 0) + 1):
                window = tuple(words[at:at + size])
                number, _ = self.automaton.get(window, (len(self.owners), 0))
                if number == len(self.owners):
                    self.automaton.add_word(window, (number, len(window)))
                    self.owners.append(set())
                if item is not None:
                    self.owners[number].add(item)
        self.automaton.make_automaton()

    def scan(self, raw: bytes) -> tuple[int, list[list[int]], set[str]]:
        """Number of words, maximal runs of hit words (first, until), items with a window here."""
        low, count, runs, seen, before = raw.lower(), 0, [], set(), ()
        for start, stop in _blocks(low):
            words = WORD.findall(low, start, stop)
            numbers = before + tuple([self.numbers.get(word, 0) for word in words])
            offset = count - len(before)  # of the numbers in the text
            if self.owners:
                for end, (window, length) in self.automaton.iter(numbers):
                    if end < len(before):
                        continue  # within the block before
                    seen.add(window)
                    until = offset + end + 1
                    first = until - length
                    while runs and runs[-1][1] >= first:
                        first = min(first, runs.pop()[0])
                    runs.append([first, until])
            count += len(words)
            before = numbers[-(self.size - 1):] if self.size > 1 else ()
        return count, runs, set().union(*[self.owners[window] for window in seen])


def _characters(raw: bytes, runs: list[list[int]]) -> list[dict]:
    """The runs with the characters of the original text they cover."""
    out, place, chars, at = [], -1, 0, 0
    words = enumerate(WORD.finditer(raw.lower()))
    for first, until in runs:
        for place, word in words:
            if place == first:
                break
        chars, at = chars + len(raw[at:word.start()].decode()), word.start()
        start = chars
        while place < until - 1:
            place, word = next(words)
        chars, at = chars + len(raw[at:word.end()].decode()), word.end()
        out.append({"first": first, "until": until, "start": start, "stop": chars})
    return out


def _scanned(texts: DataFrame, share: list[tuple[str | None, str]], size: int, hits_only: bool) -> DataFrame:
    """(key, n_words, runs, items) of each row's text."""
    sent = texts.sparkSession.sparkContext.broadcast(share)
    key = texts.schema["key"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(sent.value, size)
        for batch in batches:
            counts, runs, items = [], [], []
            for value in batch.column("text").cast(pa.binary()):
                raw = value.as_py() or b""
                count, found, owners = windows.scan(raw)
                counts.append(count)
                runs.append(_characters(raw, found) if found else [])
                items.append(sorted(owners))
            made = pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(counts, pa.int64()), pa.array(runs, ARROW_RUNS),
                 pa.array(items, pa.list_(pa.string()))],
                ["key", "n_words", "runs", "items"],
            )
            yield made.filter(pa.array(np.array([len(r) > 0 for r in runs], bool))) if hits_only else made

    return texts.select("key", "text").mapInArrow(scan, f"key {key.dataType.simpleString()}, {FOUND}")


def _united(rows: DataFrame) -> DataFrame:
    """(key, runs, items): the runs of several shares over one text as maximal runs."""
    joined = rows.groupBy("key").agg(
        F.array_sort(F.flatten(F.collect_list("runs"))).alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )

    def unite(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            united = []
            for found in frame["all"]:
                runs = []
                for run in found:
                    if runs and run["first"] <= runs[-1]["until"]:
                        if run["until"] > runs[-1]["until"]:
                            runs[-1] |= {"until": run["until"], "stop": run["stop"]}
                    else:
                        runs.append(dict(run))
                united.append(runs)
            yield pd.DataFrame({"key": frame["key"], "runs": united, "items": frame["items"]})

    return joined.mapInPandas(unite, f"key string, runs {RUNS}, items array<string>")


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, doc_id: str = "doc_id",
    text: str = "text", item_id: str = "item_id", item_text: str = "text", bound: int = SHARE_BYTES,
) -> DataFrame:
    """One row per document: `doc_id`, n_words, n_hit, runs, items.

    n_hit counts the words inside occurrences of windows; `runs` are the maximal runs of such
    words, by word (first, until) and by character of the original text (start, stop), from 0
    and without the end; `items` are the ids of items with a window in the text, as sorted
    strings.

    A null or empty text has no words and no hits; so has every text when the benchmark is
    empty or holds no words. A document without an id keeps its row. Windows of an item without
    an id count as hits, but no item is named. Repeated documents are repeated rows; repeated
    items and windows that several items share name each id once. Very long texts are read in
    blocks that overlap by the longest window less one word. Other columns of both tables,
    whatever their names, take no part.
    """
    pieces = stored(_pieces(benchmark, item_id, item_text, size), "windows")
    total = pieces.agg(F.sum("cost").alias("cost")).first().cost or 0
    if total <= bound:
        share = [(row.item, row.words) for row in pieces.collect()]
        named = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text"))
        found = _scanned(named, share, size, False).withColumnRenamed("key", doc_id)
    else:
        found = _in_shares(docs, pieces, size, doc_id, text, bound)
    hits = F.aggregate("runs", F.lit(0).cast("long"), lambda n, run: n + run["until"] - run["first"])
    return found.select(doc_id, "n_words", hits.alias("n_hit"), "runs", "items")


def _in_shares(
    docs: DataFrame, pieces: DataFrame, size: int, doc_id: str, text: str, bound: int
) -> DataFrame:
    """A pass per share of the windows. Each share is at most `bound` bytes and one piece."""
    numbered = stored(
        running_total(pieces, ["item", "place", "words"], "cost", "total")
        .select("item", "words", F.expr(f"(total - 1) div {bound}").alias("share")), "shares",
    )
    named = docs.select(
        F.col(doc_id).alias("id"), F.col(text).alias("text"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("key")
    )
    words = _scanned(named, [], size, False).groupBy("key").agg(F.first("n_words").alias("n_words"))
    found = None
    for row in numbered.select("share").distinct().orderBy("share").collect():
        share = [(r.item, r.words) for r in numbered.where(F.col("share") == row.share).collect()]
        hits = _scanned(named, share, size, True).dropDuplicates(["key"])
        found = hits if found is None else found.unionByName(hits)
    united = stored(words.join(_united(found), "key", "left"), "hits")
    return named.select("id", "key").join(united, "key").select(
        F.col("id").alias(doc_id), "n_words",
        F.coalesce("runs", F.array().cast(RUNS)).alias("runs"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def leak_digests(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """`find_leaks` by number: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return find_leaks(docs, benchmark, size).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
