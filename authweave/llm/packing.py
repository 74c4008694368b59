"""Documents to token sequences of fixed size: best fit, then swap-based local search."""

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from authweave.llm.tables import lean, stored, worker_cache

GROUP = 50_000  # short pieces packed together; the groups' number grows with the input
CACHED = 150_000  # words whose ids a task keeps; others are encoded again
ROUNDS = 8  # passes of the local search over the underfull bins
PAIRED = 64  # largest items of a bin that are tried two for one; the others are tried one for one
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"
SPLIT = (  # fixed value: the pattern of byte-level pre-tokenization
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def _byte_of() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: visible bytes stand for themselves,
    the others, in order, for the characters from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteBpe:
    """Ids of the vocabulary file's own tokenizer, word by word.

    Text is cut at spaces where no run of white space crosses the cut, so that each word is
    pre-tokenized as in its text. Words are encoded once and remembered. Texts with longer
    runs of white space or with a special token go whole to the file's tokenizer.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = _byte_of()
        self.specials = [t["content"] for t in spec["added_tokens"]]
        ranks = {
            bytes(byte_of[c] for c in token): k
            for token, k in spec["model"]["vocab"].items() if token not in self.specials
        }
        self.words = tiktoken.Encoding(
            "words", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}
        )
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            if word.isascii() or len(word) < 1000:
                found = np.array(self.words.encode_ordinary(word), "<u4").tobytes()
            else:
                found = np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) < 64:
            if len(self.known) >= CACHED:
                self.older, self.known = self.known, {}
            self.known[word] = found
        return found

    def ids(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if re.search(r" \s* ", text) or any(t in text for t in self.specials):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *rest = text.split(" ")
        known, encode = self.known.get, self._encode
        out = [self._encode(first)] if first else []
        for word in rest:
            word = " " + word
            out.append(known(word) or encode(word))
        return b"".join(out)


def pieces(ids: bytes, size: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, crc32) of each piece; only the first may be shorter than `size`."""
    n = len(ids) // 4
    start, end = 0, n % size or min(size, n)
    while start < n:
        yield start, end - start, zlib.crc32(ids[4 * start:4 * end])
        start, end = end, end + size


def tokenize(documents: DataFrame, path: str, end_id: int, size: int) -> DataFrame:
    """Pieces of each document's ids and `end_id`; a null text is an empty one."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = _encoder(path), end_id.to_bytes(4, "little")
        for frame in frames:
            rows = [
                (doc, k, *piece)
                for doc, text in zip(frame["doc_id"].tolist(), frame["text"].tolist(), strict=True)
                for k, piece in enumerate(pieces(encoder.ids(text) + end, size))
            ]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    found = documents.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).mapInPandas(lean(cut, _encoders), PIECES.replace("doc_id long", "doc_id string"))
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


_ENCODERS: dict[str, ByteBpe] = worker_cache()


def _encoders() -> dict[str, ByteBpe]:
    return _ENCODERS


def _encoder(path: str) -> ByteBpe:
    """A worker process keeps its encoder, and the words it knows, for later tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteBpe(path)
    return _ENCODERS[path]


class Bins:
    """Bins of one group: items are numbers into `sizes`."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.items: list[list[int]] = []
        self.gap: list[int] = []

    def best_fit(self) -> None:
        """Largest items first, each into the bin with the smallest gap that takes it."""
        open_bins: dict[int, list[int]] = defaultdict(list)
        mask = 0  # bit g: some bin has gap g
        for item in sorted(range(len(self.sizes)), key=lambda k: (-self.sizes[k], k)):
            size = self.sizes[item]
            above = mask >> size
            if above:
                gap = size + (above & -above).bit_length() - 1
                chosen = open_bins[gap].pop()
                if not open_bins[gap]:
                    mask &= ~(1 << gap)
                self.items[chosen].append(item)
            else:
                gap, chosen = self.capacity, len(self.items)
                self.items.append([item])
                self.gap.append(gap)
            gap -= size
            self.gap[chosen] = gap
            if gap:
                open_bins[gap].append(chosen)
                mask |= 1 << gap

    def least(self) -> int:
        """No packing has fewer bins, for any k: items over half a bin need one each, and
        those of at least k that are no larger share what is left of bins that have room
        for k."""
        full, half = self.capacity, self.capacity // 2
        number = np.bincount(np.array(self.sizes, np.int64), minlength=full + 1)[:full + 1]
        amount = number * np.arange(full + 1)
        small = np.cumsum(amount[half::-1])[::-1]  # at k: sizes from k to half
        larger = number[half + 1:].sum()
        n, used = np.cumsum(number), np.cumsum(amount)
        k = np.arange(half + 1)
        room = (n[full - k] - n[half]) * full - (used[full - k] - used[half])
        return int(larger + max(0, (-((room - small) // full)).max()))

    def used(self) -> int:
        return sum(1 for items in self.items if items)

    def _shift(self, item: int, source: int, target: int) -> None:
        self.items[source].remove(item)
        self.items[target].append(item)
        self.gap[source] += self.sizes[item]
        self.gap[target] -= self.sizes[item]

    def search(self, rounds: int) -> None:
        """Moves and exchanges that raise the sum of squared fills, until bins are empty.

        The emptiest underfull bin gives to fuller ones: an item that fits into a gap moves;
        else one item, or two, are exchanged for a smaller one such that the fuller bin
        becomes fuller still. Ends at the least possible number of bins, after a round
        without a change, or after `rounds`.
        """
        least, used = self.least(), self.used()
        for _ in range(rounds):
            if used <= least:
                return
            under = sorted(
                (b for b, g in enumerate(self.gap) if g and self.items[b]),
                key=lambda b: (-self.gap[b], b),
            )
            changed = False
            by_gap: dict[int, set[int]] = defaultdict(set)  # of the bins fuller than the source
            holders: dict[int, dict[int, int]] = defaultdict(dict)  # size: bin: an item
            for b in under:
                self._enter(b, by_gap, holders)
            for source in under:
                self._leave(source, by_gap, holders)
                changed |= self._give(source, by_gap, holders)
                used -= not self.items[source]
                if used <= least:
                    return
            if not changed:
                return

    def _give(self, source: int, by_gap, holders) -> bool:
        """Empties `source` as far as gaps of the fuller bins allow; true if anything changed."""
        changed = False
        for item in sorted(self.items[source], key=lambda k: -self.sizes[k]):
            fits = [g for g in by_gap if g >= self.sizes[item]]
            if fits:
                target = min(by_gap[min(fits)])
                self._leave(target, by_gap, holders)
                self._shift(item, source, target)
                self._enter(target, by_gap, holders)
                changed = True
        if self.items[source] and by_gap:
            changed |= self._exchange(source, by_gap, holders)
        return changed

    def _enter(self, b: int, by_gap, holders) -> None:
        if self.gap[b]:
            by_gap[self.gap[b]].add(b)
            for item in self.items[b]:
                holders[self.sizes[item]][b] = item

    def _leave(self, b: int, by_gap, holders) -> None:
        if b not in by_gap.get(self.gap[b], ()):
            return  # full, so it was never entered
        by_gap[self.gap[b]].discard(b)
        if not by_gap[self.gap[b]]:
            del by_gap[self.gap[b]]
        for item in self.items[b]:
            holders[self.sizes[item]].pop(b, None)

    def _exchange(self, source: int, by_gap, holders) -> bool:
        """One-for-one and two-for-one exchanges of `source` with a fuller bin."""
        widest, changed = max(by_gap), False
        sizes = self.sizes
        own = sorted(self.items[source], key=lambda k: -sizes[k])
        offers = [(x,) for x in own]
        offers += [(x, y) for k, x in enumerate(own[:PAIRED]) for y in own[k + 1:PAIRED]]
        for offer in offers:
            if any(x not in self.items[source] for x in offer):
                continue
            given = sum(sizes[x] for x in offer)
            found = next(
                ((b, y) for gain in range(min(widest, given - 1), 0, -1)
                 for b, y in holders.get(given - gain, {}).items()
                 if self.gap[b] >= gain and len(self.items[b]) > 0),
                None,
            )
            if found is None:
                continue
            target, back = found
            self._leave(target, by_gap, holders)
            self._shift(back, target, source)
            for x in offer:
                self._shift(x, source, target)
            self._enter(target, by_gap, holders)
            changed = True
            if not by_gap:
                break
            widest = max(by_gap)
        return changed


def pack(sizes: list[int], capacity: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """(bin, offset) of each size; bins are numbered without gaps."""
    bins = Bins(sizes, capacity)
    bins.best_fit()
    bins.search(rounds)
    places: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    for number, items in enumerate(filter(None, bins.items)):
        offset = 0
        for item in sorted(items):
            places[item] = (number, offset)
            offset += sizes[item]
    return places


def pack_documents(documents: DataFrame, path: str, end_id: int = 2, size: int = 1024) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only documents of more than `size` ids are cut; all their pieces but the first are full
    and make a sequence each. Shorter pieces are packed in groups of about GROUP, drawn by
    the place of the row in a written table, so a hot document or source spreads over all
    groups; a group wastes less than a sequence or so. Null texts are empty (the end id
    alone), repeated rows are packed each, null ids stay null, an empty table gives no rows. A
    text of any length is encoded whole, one at a time; other columns, whatever their names, are
    not looked at.
    """
    cut = stored(tokenize(documents, path, end_id, size), "pieces")
    short = F.col("length") < size
    groups = max(1, -(-cut.where(short).count() // GROUP))
    row = F.monotonically_increasing_id()
    full = cut.withColumn("sequence_id", row * 2).where(~short).withColumn("offset", F.lit(0).cast("long"))
    grouped = cut.withColumn("pack", F.pmod(F.xxhash64(row), F.lit(groups))).where(short)

    def fill(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "ids_crc32", "doc_id"], ignore_index=True)
        places = pack(frame["length"].tolist(), size)
        number = np.array([b for b, _ in places], np.int64)
        frame["sequence_id"] = ((np.int64(key[0]) << 32) + number) * 2 + 1
        frame["offset"] = np.array([o for _, o in places], np.int64)
        return frame.drop(columns="pack")

    text_ids = PACKED.replace("doc_id long", "doc_id string")
    packed = (
        grouped.withColumn("doc_id", F.col("doc_id").cast("string"))
        .groupBy("pack").applyInPandas(fill, text_ids)
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    )
    return full.select(*packed.columns).unionByName(packed)
