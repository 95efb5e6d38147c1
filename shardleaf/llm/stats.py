"""Statistics of whole texts, many texts at a time, from their bytes."""

from __future__ import annotations

import numpy as np

from . import words

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
REPEAT = 8


def _spread(owner: np.ndarray, flags: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner[flags], minlength=n).astype(np.int64)


def _ranked(owner: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items of texts: a number per distinct (text, hash), and how often each occurs."""
    _, at, counts = np.unique(h ^ words.mix(owner.astype(np.uint64) + np.uint64(1)), return_inverse=True, return_counts=True)
    return at, counts


def repeated_words(tokens: np.ndarray, owner: np.ndarray, n: int, width: int = REPEAT) -> np.ndarray:
    """Words of each text in windows of `width` words that the text holds twice or more."""
    if len(tokens) < width:
        return np.zeros(n, np.int64)
    h = words.window_hashes(tokens, width)
    start = np.flatnonzero(owner[: len(h)] == owner[width - 1 :])
    at, counts = _ranked(owner[start], h[start])
    depth = np.zeros(len(tokens) + 1, np.int32)
    again = start[counts[at] > 1]
    depth[again] += 1
    depth[again + width] -= 1
    return _spread(owner, np.cumsum(depth[:-1]) > 0, n)


def duplicate_lines(block: words.Block) -> tuple[np.ndarray, np.ndarray]:
    """(lines with a word, those of them that equal an earlier line) of each text. A line ends at U+000A only."""
    n = len(block.first) - 1
    end = np.flatnonzero(block.buf == 0x0A)
    start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
    full = np.searchsorted(block.starts, end) > np.searchsorted(block.starts, start)
    start, end = start[full], end[full]
    owner = np.searchsorted(block.offsets, start, side="right") - 1
    lines = np.bincount(owner, minlength=n).astype(np.int64)
    _, first = np.unique(words.span_hashes(block.buf, start, end) ^ words.mix(owner.astype(np.uint64) + np.uint64(1)), return_index=True)
    return lines, lines - np.bincount(owner[first], minlength=n)


def base_statistics(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_distinct, n_echo and n_upper of each text.

    word_chars: code points in words. n_echo: words equal to the word before. n_upper: ASCII capitals. Null
    counts as a text without words.
    """
    block = words.block(texts)
    n, owner, tokens = len(texts), block.owner, block.hashes()
    lines, dup = duplicate_lines(block)
    _, first = np.unique(tokens ^ words.mix(owner.astype(np.uint64) + np.uint64(1)), return_index=True)
    echo = np.flatnonzero((tokens[1:] == tokens[:-1]) & (owner[1:] == owner[:-1])) + 1
    return {
        "n_words": block.counts.astype(np.int64),
        "word_chars": block.per_text(((block.buf & 0xC0) != 0x80) & ~words.SPACE[block.buf]),
        "n_symbols": block.per_text(SYMBOLS[block.buf]),
        "n_lines": lines,
        "n_dup_lines": dup,
        "n_repeat_words": repeated_words(tokens, owner, n),
        "n_distinct": np.bincount(owner[first], minlength=n).astype(np.int64),
        "n_echo": np.bincount(owner[echo], minlength=n).astype(np.int64),
        "n_upper": block.per_text((block.buf >= 0x41) & (block.buf <= 0x5A)),
    }
