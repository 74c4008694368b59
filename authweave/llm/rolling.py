"""Hashes of spans of bytes, for all spans of a buffer at once."""

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1  # fixed value: odd, so that it has an inverse modulo 2^64
SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each bit of 64-bit numbers over all of them (the splitmix finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))  # a number for each byte value


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n + 1 of each."""
    held = max(_POWERS, default=0)
    if held < n:
        size = max(n, 1 << 18)
        inverse = pow(BASE, -1, 1 << 64)
        made = []
        for base in (BASE, inverse):
            out = np.ones(size + 1, np.uint64)
            have = 1
            while have <= size:
                more = min(have, size + 1 - have)
                step = np.uint64(pow(base, have, 1 << 64))
                out[have:have + more] = out[:more] * step
                have += more
            made.append(out)
        _POWERS.clear()
        _POWERS[size] = (made[0], made[1])
        held = size
    return _POWERS[held]


class Spans:
    """Hashes of spans [start, end) of a buffer; equal bytes have equal hashes wherever they are."""

    def __init__(self, raw: np.ndarray):
        self.power, self.inverse = powers(len(raw))
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(VALUES[raw] * self.power[:len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def all(self, size: int) -> np.ndarray:
        """Of the spans of one size at every place."""
        count = len(self.sums) - size
        if count <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[size:] - self.sums[:count]) * self.inverse[:count])


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = np.arange(97, 123)


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words [start, end) of a buffer, none of them empty; A-Z count as a-z.

    A word's blocks of eight bytes are spread with their place in the word before they are
    added up, so no algebra of the bytes makes two words alike, as it does for a polynomial.
    """
    if not len(start):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([_LOWER[raw], np.zeros(8, np.uint8)])
    blocks = (end - start + 7) // 8
    first = np.cumsum(blocks) - blocks
    word = np.repeat(np.arange(len(start)), blocks)
    place = np.arange(len(word)) - first[word]
    at = start[word] + 8 * place
    value = np.lib.stride_tricks.sliding_window_view(padded, 8)[at].view("<u8").ravel()
    value = value & _MASKS[np.minimum(end[word] - at, 8)]
    spread = mix(mix(value + np.uint64(BASE)) + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    return mix(np.add.reduceat(spread, first) + (end - start).astype(np.uint64))


def texts_of(batch, name: str) -> list:
    """The UTF-8 bytes of a string column without nulls, as views into the batch's buffer."""
    column = batch.column(name)
    _, offsets, data = column.buffers()
    kind = np.int64 if "large" in str(column.type) else np.int32
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    return [view[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def chunks(texts: list, limit: int):
    """(first, texts) runs of about `limit` bytes; a longer text is a run of its own."""
    first, held, size = 0, [], 0
    for k, text in enumerate(texts):
        if held and size + len(text) > limit:
            yield first, held
            first, held, size = k, [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, held
