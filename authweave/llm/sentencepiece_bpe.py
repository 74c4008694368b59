"""SentencePiece BPE by a table of prefixes: each prefix of a text has one last token."""

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED = 200_000  # segments a task remembers, twice
PAIRS = 1_000_000  # tested pairs a task remembers
SPACE = "▁"
WIDTH = 12  # bits of a token that hold its length; the id is above them
LENGTH = (1 << WIDTH) - 1
ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PrefixTable:
    """Encoder and decoder of one model file.

    A token can end a prefix of a text only if it is a piece that merging leaves whole and
    if it goes with the last token of the prefix before it: merging the two tokens' text
    gives the two tokens back. Exactly one token does so at each place. The table of last
    tokens is filled from left to right with the pieces that an automaton finds to end
    there, and ids are read off it backwards.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.surface = [model.id_to_piece(k) for k in range(n)]
        self.is_byte = [model.is_byte(k) for k in range(n)]
        self.byte_ids = [0] * 256
        self.score, self.ids = {}, {}
        for k in range(n):
            if model.is_unused(k):
                raise ValueError("models with unused pieces are not supported")
            if self.is_byte[k]:
                self.byte_ids[int(self.surface[k][3:-1], 16)] = k
            elif not (model.is_control(k) or model.is_unknown(k)):
                self.ids[self.surface[k]] = k
                self.score[self.surface[k]] = model.get_score(k)
        self.control = [model.is_control(k) for k in range(n)]
        self.unknown = model.unk_id()
        self.fallback = any(self.is_byte)
        self.automaton = ahocorasick.Automaton()
        for piece, k in self.ids.items():
            if self._merged(piece) == [piece]:
                self.automaton.add_word(piece, k << WIDTH | len(piece))
        self.automaton.make_automaton()
        self.decimal = [str(k) for k in range(n)]
        self.shown = [
            None if self.is_byte[k] or k == self.unknown else
            "" if self.control[k] else piece.replace(SPACE, " ")
            for k, piece in enumerate(self.surface)
        ]
        #: No piece holds a space after another character: nothing merges across such a place.
        self.splits = not any(SPACE in piece.lstrip(SPACE) for piece in self.ids)
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, tuple[str, int, str]] = {}
        self.older: dict[str, tuple[str, int, str]] = {}

    def _merged(self, text: str) -> list[str]:
        """Merging by the rule itself; used on pieces and pairs of pieces only."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging the text of two tokens gives the two back; remembered."""
        first = self.surface[left >> WIDTH] if left >= 0 else chr(~left)
        second = self.surface[right >> WIDTH]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        found = self._merged(first + second) == [first, second]
        self.pairs[left << 32 | right] = found
        return found

    def tokens(self, text: str) -> list[int]:
        """Tokens of a text in which spaces are already replaced, last one first: an id and a
        length packed into one number, or the complement of a character without a piece."""
        last = [~ord(c) for c in text]  # holds where no piece fits
        pairs, compatible, solved = self.pairs.get, self._compatible, -1
        for end, token in self.automaton.iter(text):
            if end == solved:
                continue
            start = end - (token & LENGTH)
            if start >= 0:
                before = last[start]
                found = pairs(before << 32 | token)
                if found is None:
                    found = compatible(before, token)
                if not found:
                    continue
            last[end] = token
            solved = end
        out, end = [], len(text) - 1
        while end >= 0:
            token = last[end]
            out.append(token)
            end -= token & LENGTH if token >= 0 else 1
        return out

    def _ids(self, text: str) -> list[int]:
        out = []
        for token in reversed(self.tokens(text)):
            if token >= 0:
                out.append(token >> WIDTH)
            elif self.fallback:
                out += [self.byte_ids[b] for b in chr(~token).encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.unknown:  # runs of unknown characters are one id
                out.append(self.unknown)
        return out

    def _segments(self, text: str) -> list[str]:
        """The text with its leading space, cut before runs of spaces where that is safe."""
        if not text:
            return []
        text = SPACE + text.replace(" ", SPACE)
        return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", text) if self.splits else [text]

    def encode(self, text: str) -> list[int]:
        return [k for segment in self._segments(text) for k in self._ids(segment)]

    def _surface(self, ids: list[int]) -> str:
        shown = [self.shown[k] for k in ids]
        if None not in shown:
            return "".join(shown)
        out, waiting = [], bytearray()
        for k in ids:
            if self.is_byte[k]:
                waiting.append(int(self.surface[k][3:-1], 16))
                continue
            if waiting:
                out.append(_from_bytes(waiting))
                waiting = bytearray()
            if k == self.unknown:
                out.append(" ⁇ ")
            else:
                out.append(self.shown[k])
        if waiting:
            out.append(_from_bytes(waiting))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of any ids; a space that begins the first piece is taken off."""
        first = next((k for k in ids if not self.control[k]), self.unknown)
        text = self._surface(ids)
        return text.removeprefix(" ") if first != self.unknown and not self.is_byte[first] else text

    def _segment(self, segment: str) -> tuple[str, int, str]:
        found = self.older.get(segment)
        if found is None:
            ids = self._ids(segment)
            found = ",".join([self.decimal[k] for k in ids]), len(ids), self._surface(ids)
        if len(segment) < 64:
            if len(self.known) >= CACHED:
                self.older, self.known = self.known, {}
            self.known[segment] = found
        return found

    def round_trip(self, text: str) -> tuple[str, int, str]:
        """Decimal ids joined by commas, their number, and the decoded text."""
        known, segment = self.known.get, self._segment
        found = [known(s) or segment(s) for s in self._segments(text)]
        if not self.splits or not self.fallback:
            ids = self.encode(text)
            return ",".join(map(str, ids)), len(ids), self.decode(ids)
        return (
            ",".join([f[0] for f in found]), sum([f[1] for f in found]),
            "".join([f[2] for f in found]).removeprefix(" "),
        )


def _from_bytes(raw: bytearray) -> str:
    """UTF-8; each byte that is part of no character becomes a replacement character."""
    out, at = [], 0
    while at < len(raw):
        for width in (1, 2, 3, 4):
            try:
                out.append(bytes(raw[at:at + width]).decode())
                at += width
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_TABLES: dict[str, PrefixTable] = {}


def prefix_table(path: str) -> PrefixTable:
    """A worker process keeps its table, and the segments it knows, for later tasks."""
    if path not in _TABLES:
        _TABLES[path] = PrefixTable(path)
    return _TABLES[path]


def encode_documents(documents: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (list of int) of each text; null texts have none."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = prefix_table(path)
        for frame in frames:
            rows = [(d, table.encode(t)) for d, t in zip(frame["doc_id"], frame["text"], strict=True)]
            yield pd.DataFrame(rows, columns=["doc_id", "ids"])

    return _texts(documents).mapInPandas(run, "doc_id string, ids array<int>").withColumn(
        "doc_id", F.col("doc_id").cast("long")
    )


def digest_documents(documents: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, and digests of the ids and of the text decoded from them.

    One pass without a shuffle. Null texts are empty: no ids, digests of the empty string.
    Null ids stay null, repeated rows stay repeated, an empty table gives no rows, and other
    columns, whatever their names, are not looked at. A text of any length is encoded whole, one at
    a time.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = prefix_table(path)
        for frame in frames:
            rows = []
            for doc, text in zip(frame["doc_id"].tolist(), frame["text"].tolist(), strict=True):
                ids, n, decoded = table.round_trip(text)
                rows.append((
                    doc, n, hashlib.sha256(ids.encode()).hexdigest(),
                    hashlib.sha256(decoded.encode("utf-8")).hexdigest(),
                ))
            yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(documents).mapInPandas(run, ENCODED.replace("doc_id long", "doc_id string")).withColumn(
        "doc_id", F.col("doc_id").cast("long")
    )


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
