"""Near-duplicate documents: n-gram Jaccard join with adaptive multi-match prefixes."""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from authweave.llm.components import components
from authweave.llm.filters import filter_of, held
from authweave.llm.rolling import SPACES, chunks, mix, texts_of, word_hashes
from authweave.llm.tables import again, forget, give_back, lean, small_batches, stored

CHUNK = 1 << 18  # bytes hashed at once
COUNTERS = 1 << 22  # of the table of frequencies, whatever the input's size
PART = 1 << 16  # counters of one row of that table
ENTRIES = 200_000  # prefix tokens of an index part, about
PAIRS_HELD = 300_000  # pairs a task looks at, at once
SENT = 100_000  # entries of blocks that a task of their join gets, about
BLOCK = 1000  # entries of a long posting list that are joined with as many others at once, about
HOT = 16  # level of frequency from which a posting list is dealt to several parts of the index
CHAIN = 4  # next sets by size in a long posting list that a set is tried with before its pairs are made
SHORT = 32  # documents of a posting list up to which all its pairs are counted at once
COSTS = (64, 1024, 1 << 17, 1 << 24, 1 << 31)  # estimated candidates from each of which one more match is asked
TAKEN = 6  # bytes of each token's hash that are sent and compared in the verification
MEMBERS = 2000  # sets that one copy of a center's set is compared with
GROWTH = 8  # times as many partners of a set are tried in the next round
SIGN_WORDS = (16, 1 << 10)  # 64-bit words of a set's signature, least and most: powers of 2


class Shingles:
    """Distinct word n-grams of a run of texts: `doc` (place in the run) and `token`, sorted."""

    def __init__(self, texts: list[bytes], words: int):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        space = SPACES[raw]
        before = np.concatenate([[True], space[:-1]])
        starts = np.flatnonzero(~space & before)
        ends = np.flatnonzero(space & ~before)
        bounds = np.cumsum([len(t) + 1 for t in texts])
        doc = np.searchsorted(bounds, starts, side="right")
        word = word_hashes(raw, starts, ends)
        count = np.bincount(doc, minlength=len(texts))
        left = np.cumsum(count)[doc] - np.arange(len(doc))  # words from here to the text's end
        first = left == count[doc]
        # texts of fewer words than an n-gram are one n-gram each
        kept = (left >= words) | (first & (count[doc] < words))
        at = np.flatnonzero(kept)
        total = np.zeros(len(at), np.uint64)
        for k in range(words):
            inside = left[at] > k
            part = word[np.minimum(at + k, max(len(word) - 1, 0))] + np.uint64(2 * k + 1)
            total += np.where(inside, mix(part) * np.uint64(2 * k + 3), np.uint64(0))
        token, doc = mix(total), doc[at]
        order = np.lexsort((token, doc))
        token, doc = token[order], doc[order]
        new = np.ones(len(doc), bool)
        new[1:] = (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])
        self.doc, self.token = doc[new], token[new]
        self.size = np.bincount(self.doc, minlength=len(texts))
        self.start = np.cumsum(self.size) - self.size
        #: two names of the sets
        self.name, self.second = self._names(0xA5A5A5A5A5A5A5A5), self._names(0x3C6EF372FE94F82B)

    def _names(self, salt: int) -> np.ndarray:
        """Sums of mixed tokens, which do not depend on their order."""
        sums = np.zeros(len(self.doc) + 1, np.uint64)
        np.cumsum(mix(self.token ^ np.uint64(salt)), out=sums[1:])
        return mix(sums[self.start + self.size] - sums[self.start] + self.size.astype(np.uint64))

    def signatures(self) -> list[bytes]:
        """Per set and place of its signature, a bit: whether the number of its tokens there is odd.

        A signature has a place for each token, about. Places are the last bits of a hash, so that
        one half of a signature xor the other is the signature of half the size.
        """
        words = np.exp2(np.ceil(np.log2(np.maximum(self.size, 1) / 64))).clip(*SIGN_WORDS).astype(np.int64)
        start = np.cumsum(words) - words
        place = (self.token >> np.uint64(32)).astype(np.int64) & (words[self.doc] * 64 - 1)
        places, number = np.unique(start[self.doc] * 64 + place, return_counts=True)
        odd = places[number % 2 == 1]
        made = np.zeros(words.sum(), np.uint64)
        np.bitwise_or.at(made, odd >> 6, np.uint64(1) << (odd & 63).astype(np.uint64))
        return [made[at:at + held].tobytes() for at, held in zip(start.tolist(), words.tolist(), strict=True)]

    def nodes(self, shared: np.ndarray, bits: int) -> np.ndarray:
        """One number per set: `bits` of the first name or, where other sets have that too, of both."""
        name = self.name >> np.uint64(64 - bits)
        both = mix(name ^ mix(self.second))
        return np.where(np.isin(name, shared), both, name).view(np.int64)


def _runs(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, Shingles]]:
    for first, run in chunks(texts_of(batch, "text"), CHUNK):
        yield first, Shingles(run, words)


def names_and_counts(documents: DataFrame, words: int, bits: int) -> DataFrame:
    """A row per document (doc_id, names of its set, n, signature), and rows (part, counts) of how often
    the tokens of a task's documents fell on each counter: all of them, or place and number."""

    schema = pa.schema([
        ("doc_id", pa.string()), ("node", pa.int64()), ("second", pa.int64()), ("n", pa.int64()),
        ("signature", pa.binary()), ("part", pa.int64()), ("counts", pa.binary()),
    ])
    none = np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.string())
            for first, made in _runs(batch, words):
                slots = (made.token & np.uint64(COUNTERS - 1)).astype(np.int64)
                np.add.at(counts, slots, 1)
                size = len(made.size)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(first, size), pa.array(made.nodes(none, bits)),
                    pa.array(made.second.view(np.int64)), pa.array(made.size.astype(np.int64)),
                    pa.array(made.signatures(), pa.binary()), pa.nulls(size, pa.int64()), pa.nulls(size, pa.binary()),
                ], schema=schema)
        for part in range(COUNTERS // PART):
            here = counts[part * PART:(part + 1) * PART]
            some = np.flatnonzero(here)
            if not len(some):
                continue
            if len(some) < PART // 2:
                here = np.stack([some.astype(np.uint32), here[some]])
            row = dict.fromkeys(("doc_id", "node", "second", "n", "signature"), [None])
            row |= {"part": [part], "counts": [here.tobytes()]}
            yield pa.RecordBatch.from_pydict(row, schema=schema)

    columns = "doc_id string, node long, second long, n long, signature binary, part long, counts binary"
    return stored(_texts(documents).mapInArrow(lean(run), columns), "shingle-names")


def shared_names(rows: DataFrame) -> np.ndarray:
    """First names that different sets have: with 64 bits some 70 in 5e10 sets, so they are few."""
    found = rows.groupBy("node").agg(F.min("second").alias("least"), F.max("second").alias("most"))
    names = found.where("least != most").select("node").toPandas()["node"]
    return np.sort(names.to_numpy(np.int64).view(np.uint64))


def renamed(rows: DataFrame, shared: np.ndarray) -> DataFrame:
    """The rows (doc_id, node, n, signature) with names that no two different sets have."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            name, second = (frame[c].to_numpy(np.int64).view(np.uint64) for c in ("node", "second"))
            node = np.where(np.isin(name, shared), mix(name ^ mix(second)), name).view(np.int64)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "node": node, "n": frame["n"], "signature": frame["signature"]})

    if not len(shared):
        return rows.select("doc_id", "node", "n", "signature")
    return rows.mapInPandas(lean(run), "doc_id string, node long, n long, signature binary")


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )


def frequency_levels(named: DataFrame) -> np.ndarray:
    """log2 of each counter over all documents: COUNTERS bytes, whatever the input's size."""

    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(PART, np.int64)
        for raw in frame["counts"]:
            found = np.frombuffer(raw, np.uint32)
            if len(found) == PART:
                total += found
            else:
                place, number = found.reshape(2, -1)
                total[place] += number
        level = np.ceil(np.log2(total + 1)).astype(np.uint8)
        return pd.DataFrame({"part": [key[0]], "levels": [level.tobytes()]})

    rows = (
        named.where("part is not null").select("part", "counts")
        .groupBy("part").applyInPandas(add, "part long, levels binary").collect()
    )
    levels = np.zeros(COUNTERS, np.uint8)
    for row in rows:
        levels[row.part * PART:(row.part + 1) * PART] = np.frombuffer(row.levels, np.uint8)
    return levels


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Tokens a set of n shares at least with any set of a Jaccard similarity of `percent`."""
    return -(-n * percent // 100)


def near_enough(n: np.ndarray, one: np.ndarray, k: np.ndarray, two: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and k tokens with these signatures (a row of 64-bit words each) can be similar enough.

    Each place where two signatures differ stands for a token at least that only one of the sets
    holds, and similar ones hold at most n + k - 2 c of those, c being the overlap they need.
    """
    both = n.astype(np.int64) + k
    needed = -(-percent * both // (100 + percent))
    return np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64) <= both - 2 * needed


def folded(signatures: list[bytes], words: int) -> np.ndarray:
    """The signatures at this size, a row each; none of them is smaller."""
    made, size = np.zeros((len(signatures), words), np.uint64), np.array([len(raw) // 8 for raw in signatures], np.int64)
    for held in np.unique(size):
        at = np.flatnonzero(size == held)
        some = np.frombuffer(b"".join([signatures[k] for k in at]), np.uint64).reshape(len(at), held)
        while some.shape[1] > words:
            some = some[:, :some.shape[1] // 2] ^ some[:, some.shape[1] // 2:]
        made[at] = some
    return made


def signed(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, signature) of the sets that a table of nodes names."""
    found = rows.where("doc_id is not null and n > 0").join(nodes, "node", "left_semi")
    return stored(found.select("node", "n", "signature").dropDuplicates(["node"]), "signed")


def likely(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b and other columns) that the signatures of their sets do not rule out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            n, k = frame["n_a"].to_numpy(), frame["n_b"].to_numpy()
            size = np.minimum(frame["sign_a"].map(len), frame["sign_b"].map(len)).to_numpy() // 8
            kept = np.zeros(len(frame), bool)
            for words in np.unique(size):
                at = np.flatnonzero(size == words)
                step = max(1, (1 << 21) // int(words))
                for some in (at[first:first + step] for first in range(0, len(at), step)):
                    one, two = (folded(frame[c].iloc[some].tolist(), int(words)) for c in ("sign_a", "sign_b"))
                    kept[some] = near_enough(n[some], one, k[some], two, percent)
            yield frame.loc[kept, names]

    names, schema = pairs.columns, pairs.schema
    known = signed(rows, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    for side in ("a", "b"):
        of_side = again(known).withColumnsRenamed({"node": side, "n": f"n_{side}", "signature": f"sign_{side}"})
        pairs = pairs.join(of_side, side)
    return pairs.mapInPandas(lean(run), schema)


def prefixes(made: Shingles, levels: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the prefix tokens, matches asked of each document).

    Tokens are ordered by the level of their frequency, rarest first, then by hash: the same
    order in all documents. Two sets that are similar enough share at least m of the first
    n - least_overlap(n) + m tokens of each, for any m up to the overlap. m grows with the
    candidates that the frequencies of the shortest prefix lead one to expect.
    """
    level = levels[(made.token & np.uint64(len(levels) - 1)).astype(np.int64)]
    order = np.lexsort((made.token, level, made.doc))
    n = made.size
    asked = least_overlap(n, percent)
    rank = np.arange(len(order)) - np.repeat(made.start, n)
    doc = made.doc
    noise = np.median(level) if len(level) else 0
    expected = np.where(level[order] > noise + 1, np.exp2(level[order].astype(float)), 0)
    inside = rank < np.repeat(n - asked + 1, n)
    cost = np.bincount(doc, weights=np.where(inside, expected, 0), minlength=len(n))
    matches = 1 + np.searchsorted(COSTS, cost, side="right")
    matches = np.minimum(matches, np.maximum(asked, 1))
    kept = rank < np.repeat(n - asked + matches, n)
    return order[kept], matches


#: at: the token's place in the order of its set
ENTRY = np.dtype([("token", "<u8"), ("node", "<i8"), ("n", "<u4"), ("at", "<u4"), ("m", "u1")])


def packed(entries: np.ndarray) -> bytes:
    """Entries field by field: the small numbers are compressed well that way."""
    return len(entries).to_bytes(8, "little") + b"".join(entries[name].tobytes() for name in ENTRY.names)


def unpacked(raw: bytes) -> np.ndarray:
    entries, at = np.empty(int.from_bytes(raw[:8], "little"), ENTRY), 8
    for name in ENTRY.names:
        entries[name] = np.frombuffer(raw, ENTRY[name], len(entries), at)
        at += len(entries) * ENTRY[name].itemsize
    return entries


def salts(token: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Parts of the index that a token's posting list is dealt to."""
    level = levels[(token & np.uint64(len(levels) - 1)).astype(np.int64)].astype(np.int64)
    return np.left_shift(1, np.clip(level - HOT, 0, 20))


def index_entries(documents: DataFrame, levels, words: int, percent: int, parts: int, shared, bits: int) -> DataFrame:
    """(part, entries): the prefix tokens of each distinct set of a task, by part of the index."""

    schema = pa.schema([("part", pa.int64()), ("entries", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        waiting, size = [], 0

        def flush() -> pa.RecordBatch:
            entries = np.concatenate(waiting)
            salt = mix(entries["node"].view(np.uint64)) % salts(entries["token"], levels.value).astype(np.uint64)
            part = ((entries["token"] >> np.uint64(24)) + salt) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
            some = np.flatnonzero(np.diff(cuts))
            sent = [packed(entries[order[cuts[k]:cuts[k + 1]]]) for k in some]
            return pa.RecordBatch.from_pydict({"part": some, "entries": sent}, schema=schema)

        for batch in batches:
            for _, made in _runs(batch, words):
                places, matches = prefixes(made, levels.value, percent)
                number = np.bincount(made.doc[places], minlength=len(made.size))
                at = np.arange(len(places)) - np.repeat(np.cumsum(number) - number, number)
                fresh, nodes = np.zeros(len(made.size), bool), made.nodes(shared, bits)
                for k, name in enumerate(nodes.tolist()):
                    if name not in seen:
                        fresh[k] = True
                        seen.add(name)
                if len(seen) > 200_000:
                    seen.clear()
                kept = fresh[made.doc[places]]
                places, at = places[kept], at[kept]
                doc = made.doc[places]
                entries = np.empty(len(places), ENTRY)
                entries["token"], entries["node"] = made.token[places], nodes[doc]
                entries["n"], entries["m"], entries["at"] = made.size[doc], matches[doc], at
                waiting.append(entries)
                size += len(entries)
                if size >= ENTRIES:
                    yield flush()
                    waiting, size = [], 0
        if size:
            yield flush()

    return _texts(documents.where("doc_id is not null")).mapInArrow(lean(run), "part long, entries binary")


PAIR = "a long, b long, shared long, asked long"


def _lists(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of tokens that several sets hold, by token and set size; starts and lengths."""
    entries = entries[np.lexsort((entries["node"], entries["n"], entries["token"]))]
    if len(entries) > 1:  # a set that several tasks saw
        same = (entries["token"][1:] == entries["token"][:-1]) & (entries["node"][1:] == entries["node"][:-1])
        entries = entries[np.r_[True, ~same]]
    cut = np.r_[True, entries["token"][1:] != entries["token"][:-1]] if len(entries) else np.zeros(0, bool)
    starts = np.flatnonzero(cut)
    lengths = np.diff(np.r_[starts, len(entries)])
    return entries, starts, lengths


def reach(n: np.ndarray, at: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Largest size of a set with which a set of n can be similar enough and be met at place `at`.

    Sets of n and k tokens that are similar enough share at least
    c = ceil(percent * (n + k) / (100 + percent)) tokens, so m of the shared ones are among the
    first n - c + m of the one and among the first k - c + m of the other.
    """
    return (n.astype(np.int64) + m - 1 - at) * (100 + percent) // percent - n


def _fits(small: tuple, large: tuple, percent: int) -> np.ndarray:
    """Whether sets (n, at, m), the smaller first, can be similar enough and met at these places."""
    (n, at, m), (k, there, asked) = ([x.astype(np.int64) for x in side] for side in (small, large))
    asked = np.minimum(m, asked)
    return (
        (n * 100 >= k * percent)
        & (reach(n, at, asked, percent) >= k) & (reach(k, there, asked, percent) >= n)
    )


def _places(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return entries["n"], entries["at"], entries["m"]


def _counted(a, b, asked) -> pd.DataFrame:
    """Pairs with the number of tokens they were met at."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((high, low))
    low, high, asked = low[order], high[order], asked[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    at = np.flatnonzero(new)
    return pd.DataFrame({
        "a": low[at], "b": high[at], "shared": np.diff(np.r_[at, len(low)]), "asked": asked[at],
    })


def meet(entries: np.ndarray, percent: int, levels: np.ndarray) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of the short posting lists, counted; entries of the long lists, their stars and
    chains; (token, star center) of lists that other parts hold some of, which count as long.

    In a long list each set is paired with the smallest name, and with the next ones by size, where
    a pair can be similar enough and be met at the token's places.
    """
    entries, starts, lengths = _lists(entries)
    dealt = salts(entries["token"][starts], levels) > 1
    short = np.flatnonzero((lengths > 1) & (lengths <= SHORT) & ~dealt)
    found = []
    for step in range(1, SHORT):
        lists = short[lengths[short] > step]
        if not len(lists):
            break
        number = lengths[lists] - step
        first = np.repeat(starts[lists], number) + np.arange(number.sum()) - np.repeat(
            np.cumsum(number) - number, number
        )
        one, two = entries[first], entries[first + step]
        fit = _fits(_places(one), _places(two), percent)
        one, two = one[fit], two[fit]
        found.append(np.stack([one["node"], two["node"], np.minimum(one["m"], two["m"]).astype(np.int64)]))
    a, b, asked = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    long = np.flatnonzero((lengths > SHORT) | dealt)
    member = np.zeros(len(entries), bool)
    stars, centers, chains = [], [], []
    for k in long:
        part = entries[starts[k]:starts[k] + lengths[k]]
        member[starts[k]:starts[k] + lengths[k]] = True
        at = int(part["node"].argmin())
        center = _places(part[at:at + 1])
        fit = np.r_[_fits(_places(part[:at]), center, percent), False, _fits(center, _places(part[at + 1:]), percent)]
        stars.append(np.stack([part["node"][fit], np.full(fit.sum(), part["node"][at])]))
        for step in range(1, CHAIN + 1):
            fit = _fits(_places(part[:-step]), _places(part[step:]), percent)
            chains.append(np.stack([part["node"][:-step][fit], part["node"][step:][fit]]))
        if dealt[k]:
            centers.append([part["token"].view(np.int64)[0], part["node"][at]])
    star = np.concatenate(stars, axis=1) if stars else np.zeros((2, 0), np.int64)
    center = np.array(centers, np.int64).reshape(-1, 2).T
    chain = np.concatenate(chains, axis=1) if chains else np.zeros((2, 0), np.int64)
    return _counted(a, b, asked), entries[member], star, center, chain


def candidates(index: DataFrame, levels, percent: int) -> DataFrame:
    """Rows of five kinds: counted pairs; star pairs (shared null, asked: the lists that gave
    it) and chain pairs (the same, part 0); entries of long lists as (part, entries); star
    centers (b null) of a token (part)."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        give_back()
        entries = np.concatenate([unpacked(raw) for raw in frame["entries"]])
        pairs, long, star, center, chain = meet(entries, percent, levels.value)
        del entries
        star, votes = np.unique(np.sort(star, axis=0), axis=1, return_counts=True)
        stars = pd.DataFrame({"a": star[0], "b": star[1], "asked": votes})
        chain, votes = np.unique(np.sort(chain, axis=0), axis=1, return_counts=True)
        chains = pd.DataFrame({"a": chain[0], "b": chain[1], "asked": votes, "part": 0})
        rest = pd.DataFrame({"part": [key[0]], "entries": [packed(long)]}) if len(long) else None
        centers = pd.DataFrame({"part": center[0], "a": center[1]})
        kinds = {k: "Int64" for k in ("a", "b", "shared", "asked", "part")} | {"entries": "object"}
        # the types come first: names put beside missing values would be rounded to doubles
        made = [f.reindex(columns=list(kinds)).astype(kinds) for f in (pairs, stars, chains, centers, rest) if f is not None and len(f)]
        return pd.concat(made, ignore_index=True) if made else pd.DataFrame(columns=list(kinds)).astype(kinds)

    schema = PAIR + ", part long, entries binary"
    return stored(index.groupBy("part").applyInPandas(run, schema), "candidates")


def crossing(long: DataFrame, reached: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """Pairs of long lists whose sets are not connected yet, with partial counts.

    Pairs that their signatures, at the least size, rule out are not made.

    A list is cut by bands of set sizes, and a band into blocks of about BLOCK entries; a
    component of more entries than that has blocks of its own. Blocks are joined block with
    block, in the same band and with the next one, but not within one component. A block of
    smaller sets gives only entries that reach sets of their own size.
    """
    width = max(math.log(100 / percent) * 1.000001, 0.01)

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for raw in frame["entries"]:
                part = unpacked(raw)
                n, at, m = (x.astype(np.int64) for x in _places(part))
                yield pd.DataFrame({
                    "token": part["token"].astype(np.uint64).view(np.int64), "node": part["node"],
                    "n": n, "at": at, "m": m, "band": (np.log(n) // width).astype(np.int64),
                    "low": reach(n, at, m, percent) >= n,
                })

    def cross(one: pd.DataFrame, two: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Pairs of a smaller set of `one` and a larger set of `two`, some rows at a time."""
        a, b = ({c: side[c].to_numpy() for c in side.columns} for side in (one, two))
        signs = [folded(side["signature"].tolist(), SIGN_WORDS[0]) for side in (one, two)]
        for start in range(0, len(one), max(1, PAIRS_HELD // len(two))):
            rows = slice(start, start + max(1, PAIRS_HELD // len(two)))
            n, node = a["n"][rows, None], a["node"][rows, None]
            apart = a["component"][rows, None] != b["component"]
            i, j = np.nonzero(apart & ((n < b["n"]) | ((n == b["n"]) & (node < b["node"]))))
            i += start
            fit = _fits((a["n"][i], a["at"][i], a["m"][i]), (b["n"][j], b["at"][j], b["m"][j]), percent)
            i, j = i[fit], j[fit]
            fit = near_enough(a["n"][i], signs[0][i], b["n"][j], signs[1][j], percent)
            i, j = i[fit], j[fit]
            if len(i):
                yield _counted(a["node"][i], b["node"][j], np.minimum(a["m"][i], b["m"][j]))

    def join_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, last = [], None

        def done() -> Iterator[pd.DataFrame]:
            both = pd.concat(waiting)
            one, two = both[both["smaller"]], both[~both["smaller"]]
            if len(one) and len(two):
                yield from cross(one, two)

        for frame in frames:
            for name, part in frame.groupby("meeting", sort=False):
                if waiting and name != last:
                    yield from done()
                    waiting = []
                waiting.append(part)
                last = name
        if waiting:
            yield from done()

    rows = long.mapInPandas(lean(spread), "token long, node long, n long, at long, m long, band long, low boolean")
    rows = rows.join(reached.withColumnRenamed("id", "node"), "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    groups = stored(
        rows.groupBy("token", "band", "component").agg(F.count("*").alias("held")), "groups"
    )
    open_tokens = groups.groupBy("token").agg(
        F.min("component").alias("least"), F.max("component").alias("most")
    ).where("least != most").select("token")
    alone = F.col("held") > BLOCK
    rest = groups.groupBy("token", "band").agg(F.sum(F.when(~alone, F.col("held"))).alias("others"))
    cuts = (
        again(groups).join(rest, ["token", "band"]).join(open_tokens, "token")
        .select(
            "token", "band", "component", F.when(alone, F.col("component")).alias("own"),
            F.ceil(F.when(alone, F.col("held")).otherwise(F.col("others")) / BLOCK).alias("blocks"),
        )
    )
    number = F.pmod(F.xxhash64("node"), F.col("blocks"))
    rows = stored(
        rows.join(cuts, ["token", "band", "component"]).withColumn(
            "block", F.concat_ws(":", "token", "band", F.coalesce(F.col("own").cast("string"), F.lit("")), number)
        ).select("token", "node", "n", "at", "m", "band", "low", "component", "own", "block"),
        "blocked",
    )
    blocks = stored(
        rows.groupBy("block").agg(
            F.first("token").alias("token"), F.first("band").alias("band"), F.first("own").alias("own"),
            F.count("*").alias("held"), F.count_if("low").alias("lows"),
        ), "blocks",
    )
    smaller = blocks.where("lows > 0").select(
        "token", F.explode(F.array("band", F.col("band") + 1)).alias("band"),
        F.col("block").alias("one"), F.col("own").alias("own_one"), "lows",
    )
    larger = again(blocks).drop("lows").withColumnsRenamed({"block": "two", "own": "own_two"})
    meetings = stored(
        smaller.join(larger, ["token", "band"])
        .where("own_one is null or own_two is null or own_one != own_two")
        .select("one", "two", F.concat_ws("|", "one", "two").alias("meeting"), (F.col("lows") + F.col("held")).alias("sent")),
        "meetings",
    )
    sent = meetings.agg(F.sum("sent")).first()[0] or 0
    parts = max(12, -(-sent // SENT))
    columns = ["meeting", "smaller", "node", "n", "at", "m", "component", "signature"]
    met = again(rows).join(signed(named, again(rows).select("node").distinct()).select("node", "signature"), "node")
    sides = [
        met.where(F.lit(True) if side == "two" else F.col("low"))
        .join(again(meetings).select("meeting", F.col(side).alias("block")), "block")
        .withColumn("smaller", F.lit(side == "one")).select(*columns)
        for side in ("one", "two")
    ]
    return (
        sides[0].unionByName(sides[1]).repartition(parts, "meeting").sortWithinPartitions("meeting")
        .mapInPandas(lean(join_blocks), PAIR)
    )


def token_sets(documents: DataFrame, pairs: DataFrame, words: int, shared, bits: int) -> DataFrame:
    """(node, tokens) of the sets that pairs name; the fixed-size filter lets few others pass."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    passing = documents.sparkSession.sparkContext.broadcast(filter_of(nodes, "node"))

    schema = pa.schema([("node", pa.int64()), ("tokens", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, made in _runs(batch, words):
                names = made.nodes(shared, bits)
                nodes, sets = [], []
                for k in np.flatnonzero(held(passing.value, names)):
                    if int(names[k]) in seen:
                        continue
                    seen.add(int(names[k]))
                    nodes.append(int(names[k]))
                    tokens = made.token[made.start[k]:made.start[k] + made.size[k]] >> np.uint64(64 - 8 * TAKEN)
                    sets.append(tokens.view(np.uint8).reshape(-1, 8)[:, :TAKEN].tobytes())
                if len(seen) > 200_000:
                    seen.clear()
                yield pa.RecordBatch.from_pydict({"node": nodes, "tokens": sets}, schema=schema)

    kept = _texts(documents.where("doc_id is not null")).mapInArrow(lean(run), "node long, tokens binary")
    return kept.dropDuplicates(["node"])


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Tokens that two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
    return int((b[at] == a).sum()) if len(b) else 0


def verified(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole token sets are similar enough.

    The set of b is sent to that of a; an a with many partners is sent to them in copies, for
    MEMBERS partners each. A task holds one set of an a at a time. The pairs are stored.
    """
    counted = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).alias("copies"))
    members = again(pairs).select("a", "b").join(counted, "a").select(
        F.col("b").alias("node"), F.col("a").alias("center"),
        F.pmod(F.xxhash64("b"), F.col("copies")).alias("copy"), F.lit(False).alias("leads"),
    )
    leads = counted.select(
        F.col("a").alias("node"), F.col("a").alias("center"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"), F.lit(True).alias("leads"),
    )
    routes = stored(members.unionByName(leads), "routes")

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center, lead = None, np.zeros(0, np.uint64)
        for batch in batches:
            found = []
            columns = [batch.column(name).to_pylist() for name in ("center", "leads", "node")]
            for at, leads, node, raw in zip(*columns, texts_of(batch, "tokens"), strict=True):
                tokens = np.zeros((len(raw) // TAKEN, 8), np.uint8)
                tokens[:, :TAKEN] = np.frombuffer(raw, np.uint8).reshape(-1, TAKEN)
                tokens = tokens.view(np.uint64).ravel()
                if leads:
                    center, lead = at, tokens
                elif center == at:  # always: a center's set comes before its partners'
                    both = overlap(lead, tokens)
                    if 100 * both >= percent * (len(lead) + len(tokens) - both):
                        found.append((at, node))
            yield pa.RecordBatch.from_pydict({"a": [a for a, _ in found], "b": [b for _, b in found]}, schema=links)

    links = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    parts = max(12, -(-routes.count() // (10 * MEMBERS)))
    sent = (
        sets.join(routes, "node").repartition(parts, "center", "copy")
        .sortWithinPartitions("center", "copy", F.desc("leads"))
    )
    return stored(sent.mapInArrow(lean(similar), "a long, b long"), "similar")


def _components_of(pairs: DataFrame, reached: DataFrame) -> DataFrame:
    """The pairs (a, b) that are not connected, with the components of both."""
    for side in ("a", "b"):
        names = again(reached).withColumnsRenamed({"id": side, "component": f"of_{side}"})
        pairs = pairs.join(names, side, "left").withColumn(f"of_{side}", F.coalesce(f"of_{side}", side))
    return pairs.where("of_a != of_b")


def connect(documents: DataFrame, pairs: DataFrame, reached: DataFrame, words: int, percent: int, shared, bits: int) -> DataFrame:
    """Verifies the pairs, but for those whose sets are connected by then: (id, component).

    A round tries some partners of each set, up to GROWTH times as far as the last one, and
    what it connects is not compared any more: a large group is connected by few links before
    all its pairs come up. Each pair comes up in one round. Links are kept between components,
    once each.
    """
    sets, tried, before = None, 1, 0
    left = stored(_components_of(pairs, reached).select("a", "b"), "open")
    place = F.row_number().over(Window.partitionBy("b").orderBy("a"))
    ranked = stored(left.withColumn("place", place), "ranked")
    forget(left)
    most = ranked.agg(F.max("place")).first()[0] or 0
    while before < most:
        due = again(ranked).where((F.col("place") > before) & (F.col("place") <= tried)).select("a", "b")
        chosen = stored(_components_of(due, reached), "chosen")
        if chosen.limit(1).count():
            if sets is None:
                sets = stored(token_sets(documents, again(ranked), words, shared, bits), "token-sets")
            links = verified(sets, chosen, percent)
            if links.limit(1).count():
                between = again(chosen).join(links, ["a", "b"]).select("of_a", "of_b").distinct()
                known = reached.select(F.col("id").alias("of_a"), F.col("component").alias("of_b"))
                reached = stored(components(known.unionByName(between), "of_a", "of_b"), "reached")
        forget(chosen)
        before, tried = tried, tried * GROWTH
    forget(ranked)
    if sets is not None:
        forget(sets)
    return reached


class Groups:
    """Documents by the sets they hold, and sets by what they are linked with.

    `rows`: doc_id, node, n per document; `sets`: node, doc_id (the smallest that holds it),
    component per set of documents with an id; `shared` and `bits` make the nodes of other rows.
    """

    def __init__(self, rows: DataFrame, sets: DataFrame, shared: np.ndarray, bits: int):
        self.rows, self.sets, self.shared, self.bits = rows, sets, shared, bits


def grouped(documents: DataFrame, words: int, percent: int, name_bits: int = 64) -> Groups:
    """Links the sets of documents (doc_id, text).

    A set holds the distinct runs of `words` words (A-Z lower-cased, split at ASCII white
    space); a text of fewer words is one run, one without words has an empty set. Sets link
    when their Jaccard similarity is at least `percent` %. Equal sets are one set from the
    start: those whose tokens, 64-bit hashes, give the same two names of 64 bits. Sets that
    share only the first name (`name_bits` of it, fewer for tests alone) get a new one from both.
    Other sets are compared by 48 bits of their tokens' hashes.

    1. One pass names the sets and counts tokens in a table of fixed size.
    2. One pass sends the prefix tokens of each set to the parts of an index. Lists of up to
       SHORT sets count their pairs; longer ones give stars, and their entries are kept. Lists
       of very frequent tokens are dealt to several parts. A pair counts a token only where
       the sizes and the token's places in both sets leave room for the overlap it needs.
    3. A pair is a candidate when it shares as many prefix tokens as the less demanding of its
       documents asks, and when the signatures of its sets, parities of their tokens at a fixed
       number of places, do not show that too many tokens differ.
    4. Each set is first verified against its smallest candidate partner, its commonest star
       center and the sets that share most of its long lists among its next ones by size, so that
       a large group of near copies is connected before its pairs are made. What that connects
       needs no further comparison.
    5. All other candidates that are not connected, those of the long lists included, which are
       joined in blocks, are then verified in rounds. No partner is dropped for the length of a
       list.

    A very long text is hashed at once, which takes some 50 times its size.
    """
    small_batches(documents.sparkSession)
    named = names_and_counts(documents, words, name_bits)
    rows = named.where("part is null")
    shared = shared_names(rows)
    rows = renamed(rows, shared).withColumn("doc_id", F.col("doc_id").cast("long"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    levels = documents.sparkSession.sparkContext.broadcast(frequency_levels(named))
    parts = max(12, -(-total * (104 - percent) // 100 // ENTRIES))
    index = index_entries(documents, levels, words, percent, parts, shared, name_bits).repartition(parts, "part")
    found = candidates(index, levels, percent)
    centers = found.where("a is not null and b is null").select(F.col("part").alias("token"), F.col("a").alias("b"))
    joined = centers.join(centers.groupBy("token").agg(F.min("b").alias("a")), "token").where("a != b")
    votes = F.when(F.col("shared").isNull(), F.col("asked"))
    met = found.where("b is not null").select(
        "a", "b", "shared", F.when(F.col("shared").isNotNull(), F.col("asked")).alias("asked"),
        F.when(F.col("part").isNull(), votes).alias("star"), F.when(F.col("part") == 0, votes).alias("chain"),
    )
    none = F.lit(None).cast("long")
    met = met.unionByName(joined.select("a", "b", *[none.alias(c) for c in ("shared", "asked", "chain")], F.lit(1).cast("long").alias("star")))
    met = met.groupBy("a", "b").agg(*[f(c).alias(c) for c, f in (("shared", F.sum), ("asked", F.max), ("star", F.sum), ("chain", F.sum))])
    pairs = stored(likely(stored(met, "met"), rows, percent), "pairs")
    nearest = again(pairs).where("shared >= asked").groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    stars = again(pairs).where("star > 0").groupBy("b").agg(F.max_by("a", F.struct("star", "a")).alias("a")).select("a", "b")
    place = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("chain"), "a"))
    chains = again(pairs).where("chain > 0").withColumn("place", place).where(F.col("place") <= CHAIN).select("a", "b")
    first = stored(nearest.union(stars).union(chains).distinct(), "first-pairs")
    links = verified(token_sets(documents, first, words, shared, name_bits), first, percent)
    reached = stored(components(links, "a", "b"), "reached")

    long = found.where("entries is not null").select("part", "entries")
    counted = again(pairs).where("shared > 0").select("a", "b", "shared", "asked")
    more = crossing(long, reached, rows, percent) if long.limit(1).count() else None
    if more is not None:
        counted = counted.unionByName(more).groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("asked").alias("asked"))
    rest = counted.where("shared >= asked").select("a", "b").join(again(first), ["a", "b"], "left_anti")
    if more is not None:
        rest = likely(stored(rest, "rest"), rows, percent)
    reached = connect(documents, rest, reached, words, percent, shared, name_bits)

    known = rows.where("doc_id is not null and n > 0")
    least = known.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    sets = (
        least.join(reached.withColumnRenamed("id", "node"), "node", "left")
        .select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    )
    return Groups(rows.select("doc_id", "node", "n"), sets, shared, name_bits)


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 75, name_bits: int = 64) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of documents (doc_id, text).

    Null texts are empty, rows without an id link with nothing and have a null component,
    repeated rows stay repeated, an empty table gives no rows, other columns, whatever their names,
    are not looked at.
    """
    found = grouped(documents, words, percent, name_bits)
    smallest = found.sets.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = found.sets.join(smallest, "component").select("node", "component_id")
    known = found.rows.where("doc_id is not null and n > 0")
    linked = known.join(of_node, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = found.rows.where("doc_id is null or n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    return linked.unionByName(alone)


def keep_one(documents: DataFrame, words: int = 5, percent: int = 75, name_bits: int = 64) -> DataFrame:
    """One row of each group of near copies: of those with the smallest id one, all others go.

    Rows are told apart by id and set, so of two texts under one id each stays if nothing else
    that is like it has a smaller id. Rows without an id or without words all stay. All columns are
    kept, whatever their names; an empty table gives no rows.
    """
    found = grouped(documents, words, percent, name_bits)
    chosen = stored(
        found.sets.groupBy("component").agg(F.min(F.struct("doc_id", "node")).alias("one")).select("one.*"), "chosen"
    )
    known = found.rows.where("doc_id is not null")
    several = stored(known.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id"), "several")
    ids = chosen.select("doc_id").unionByName(known.where("n = 0").select("doc_id"))
    kept = documents.join(ids.join(several, "doc_id", "left_anti"), "doc_id", "left_semi")
    if several.limit(1).count():
        rows = stored(_with_nodes(documents.join(again(several), "doc_id", "left_semi"), words, found), "several-rows")
        wordy = again(rows).where("n > 0").join(again(chosen), ["doc_id", "node"], "left_semi").dropDuplicates(["doc_id", "node"])
        kept = kept.unionByName(rows.where("n = 0").select("row.*")).unionByName(wordy.select("row.*"))
    return kept.unionByName(documents.where("doc_id is null")).select(*[F.col(f"`{c}`") for c in documents.columns])


def _with_nodes(documents: DataFrame, words: int, found: Groups) -> DataFrame:
    """(row, doc_id, node, n): the rows as they are, and the sets of their texts."""
    shared, bits = found.shared, found.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, made in _runs(batch, words):
                here = batch.slice(first, len(made.size))
                yield pa.RecordBatch.from_arrays(
                    [here.column("row"), here.column("doc_id"), pa.array(made.nodes(shared, bits)),
                     pa.array(made.size.astype(np.int64))], ["row", "doc_id", "node", "n"],
                )

    rows = documents.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.mapInArrow(lean(run), StructType(rows.schema.fields[:2]).add("node", "long").add("n", "long"))
