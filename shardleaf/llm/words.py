"""Whole texts as arrays: word positions, word hashes and Rabin-Karp window hashes, all in numpy.

A word is a run of bytes other than U+0020 and U+0009 to U+000D. These are single bytes in UTF-8, so
texts are never decoded. Work is done on blocks of several texts at a time, and byte arrays wider than
a slice are never built, so memory follows the block and the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 21  # bytes of text in a block of several texts
SLICE = 1 << 20  # bytes hashed at a time
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes other than ASCII letters, digits and parts of longer characters.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        steps = np.full(max(n, SLICE + 4096), base, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=np.uint64)
        if len(known) <= 4 * SLICE:
            _powers[int(base)] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _prefix(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=out[1:], dtype=np.uint64)
    return out


def window_hashes(tokens: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every run of `width` tokens, in order; none if there are fewer tokens."""
    n = len(tokens) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for a in range(0, n, SLICE):
        b = min(n, a + SLICE)
        sums = _prefix(tokens[a : b + width - 1])
        out[a:b] = (sums[width:] - sums[:-width]) * powers(INVERSE, b - a)
    return mix(out)


@dataclass
class Block:
    """Texts side by side, each with a line end after it. starts and ends are byte positions of words in buf; first[i] : first[i + 1] are the words of text i."""

    buf: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each text has."""
        return np.add.reduceat(flags, self.offsets[:-1], dtype=np.int64) if len(self.offsets) > 1 else np.zeros(0, np.int64)

    def hashes(self, seed: int = 0, table: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word, of its bytes as given or as `table` maps them."""
        return span_hashes(self.buf, self.starts, self.ends, seed, table)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0, table: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each ascending, non-overlapping span of bytes."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE, side="right")))
        a = int(starts[i])
        part = buf[a : int(ends[j - 1])]
        sums = _prefix((part if table is None else table[part]).astype(np.uint64) + np.uint64(1))
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (sums[e] - sums[s]) * powers(INVERSE, len(part) + 1)[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out + mix(np.array([seed + 1], np.uint64)))


def block(texts: Sequence[bytes | None], space: np.ndarray = SPACE) -> Block:
    """Texts as one block; null counts as a text without words. space says which bytes separate words."""
    data = b"".join((t or b"") + b"\n" for t in texts)
    sizes = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    buf = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~space[buf]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[0::2], edges[1::2]
    first = np.searchsorted(starts, offsets)
    return Block(buf, offsets, starts, ends, first)


def groups(texts: Sequence[bytes | None], limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `limit` bytes each; a longer text has a range of its own."""
    a = size = 0
    for i, t in enumerate(texts):
        n = len(t or b"")
        if i > a and size + n > limit:
            yield a, i
            a, size = i, 0
        size += n
    if a < len(texts):
        yield a, len(texts)


def pieces(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, list[bytes | None]]]:
    """(a, b, texts a to b) as `groups` cuts a binary column; only the texts of one range at a time are copied out of it."""
    a = size = 0
    for i, t in enumerate(column):
        n = t.as_buffer().size if t.is_valid else 0
        if i > a and size + n > limit:
            yield a, i, column[a:i].to_pylist()
            a, size = i, 0
        size += n
    if a < len(column):
        yield a, len(column), column[a:].to_pylist()
