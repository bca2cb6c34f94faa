"""Words of many texts at once, as arrays of positions and 64-bit hashes."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
#: Bytes that are hashed in one go; longer data are cut at separators.
PIECE = 1 << 18


@functools.lru_cache(maxsize=8)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        out = np.full(n + 1, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return table(_BASE), table(pow(_BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser: every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def separators(keep: bytes | None = None, drop: bytes | None = None) -> np.ndarray:
    """A table of bytes that end words: all but ``keep``, or just ``drop``."""
    out = np.full(256, keep is not None)
    out[list(keep if drop is None else drop)] = drop is not None
    return out


#: White space of the word contract, and everything but letters, as bytes of UTF-8.
SPACES = separators(drop=b" \t\n\x0b\x0c\r")
NOT_LETTERS = separators(keep=bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))


def spans(data: np.ndarray, ends_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``."""
    out = ends_word[data]
    edges = np.flatnonzero(out[1:] != out[:-1]) + 1
    first = np.concatenate([[0] * (len(out) > 0 and not out[0]), edges, [len(data)] * (len(out) > 0 and not out[-1])]).astype(np.int64)
    return first[0::2], first[1::2]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """A 64-bit hash of every word; equal words have equal hashes wherever they are."""
    out = np.empty(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        low = int(starts[k])
        # as many words as fit a piece, one at least
        j = max(k + 1, int(np.searchsorted(ends, low + piece, side="right")))
        high = int(ends[j - 1])
        size = 1 << max(12, (high - low).bit_length())
        up, down = _powers(size if size <= piece * 2 else high - low)
        sums = np.empty(high - low + 1, np.uint64)
        sums[0] = 0
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        s, e = starts[k:j] - low, ends[k:j] - low
        out[k:j] = mix((sums[e] - sums[s]) * down[s])
        k = j
    return out


def groups(texts: Sequence[str], limit: int = 2 * PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``limit`` characters; a longer text is alone."""
    low = size = 0
    for i, x in enumerate(texts):
        if size and size + len(x) > limit:
            yield low, i
            low, size = i, 0
        size += len(x)
    if low < len(texts):
        yield low, len(texts)


class Words:
    """The words of ``texts``: ``row`` (index of the text), start, end, hash."""

    def __init__(self, texts: Sequence[str], ends_word: np.ndarray, lower: bool = True) -> None:
        raw = [x.encode("utf-8", "surrogatepass") for x in texts]
        joined = b"\n".join(raw) + b"\n"
        if lower:  # A-Z only
            joined = joined.lower()
        self.data = np.frombuffer(joined, np.uint8)
        self.begins = np.concatenate([[0], np.cumsum([len(x) + 1 for x in raw])]).astype(np.int64)
        self.start, self.end = spans(self.data, ends_word)
        self.first = np.searchsorted(self.start, self.begins)  # of each text, and the end
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(texts)), self.count)
        self.hash = hashes(self.data, self.start, self.end)

    def prefix(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the words of ``size`` bytes or more, and hashes of so many first bytes."""
        long = np.flatnonzero(self.end - self.start >= size)
        s = self.start[long]
        return long, mix(hashes(self.data, s, s + size) + np.uint64(size))
