"""Quality classifier: a generalised additive model with pairwise interactions, by cyclic boosting of shallow trees.

Every statistic of a text has a lookup table over its bins, and chosen pairs of statistics have one over a
coarse grid. Boosting goes round the statistics again and again; each turn fits a tree with a few leaves to the
gradient of the log loss on that statistic alone and adds a little of it to its table. Then pairs are
ranked by what one cut each way would still gain, and the best ones are boosted in turn. A score is a sum of
table look-ups, done for many texts at once. The model is fitted on a bounded sample of labelled rows;
scoring reads every text whole.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from . import words
from .samples import labelled_sample
from .stats import base_statistics

MAX_LABELLED = 20_000
BINS = 32
GRID = 8
ROUNDS = 150
PAIR_ROUNDS = 50
PAIRS = 8
RATE = 0.1
MIN_LEAF = 5.0
L2 = 1.0
FEATURES = (
    "log_words", "word_length", "symbols", "distinct", "echo", "capitals", "repeats", "duplicate_lines", "line_words", "marks", "digits", "shouts",
)
_MARKS, _DIGITS, _SHOUTS = (np.isin(np.arange(256), list(s)) for s in (b".,;:?!", b"0123456789", b"!"))


def features(texts: list[bytes | None]) -> np.ndarray:
    """One row per text, one column per name in FEATURES; null and empty texts give zeros."""
    s = base_statistics(texts)
    block = words.block(texts)
    n, chars, lines = (np.maximum(s[c], 1).astype(float) for c in ("n_words", "word_chars", "n_lines"))
    return np.stack([
        np.log1p(s["n_words"]), s["word_chars"] / n, s["n_symbols"] / n, np.log1p(s["n_distinct"]) / np.log1p(n), s["n_echo"] / n,
        s["n_upper"] / chars, s["n_repeat_words"] / n, s["n_dup_lines"] / lines, np.log1p(s["n_words"] / lines),
        *(block.per_text(marked[block.buf]) / n for marked in (_MARKS, _DIGITS, _SHOUTS)),
    ], 1)


@F.arrow_udf(ArrayType(DoubleType()))
def _features(texts: pa.Array) -> pa.Array:
    raw = [t.as_py() for t in texts]
    parts = [features(raw[a:b]) for a, b in words.groups(raw)]
    values = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, len(FEATURES), dtype=np.int32), values.ravel())


@dataclass
class Additive:
    """intercept; per feature the inner bin edges and a table; per pair the features, coarse edges and a GRID x GRID table."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray]
    grids: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], side="right")]
        for (a, b), grid in zip(self.pairs, self.grids):
            at = [np.searchsorted(self.coarse[f], x[:, f], side="right") for f in (a, b)]
            total += grid[at[0], at[1]]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins, method="higher")) if len(column) else np.zeros(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + L2)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Values per bin of a tree with up to `leaves` leaves, grown by the best cut each time; g, h, n: sums per bin."""
    cuts = [0, len(g)]
    for _ in range(leaves - 1):
        best = (1e-9, -1)
        for a, b in itertools.pairwise(cuts):
            if b - a < 2:
                continue
            left = [np.cumsum(v[a:b])[:-1] for v in (g, h, n)]
            right = [v[a:b].sum() - w for v, w in zip((g, h, n), left)]
            gain = _gain(*left[:2]) + _gain(*right[:2]) - _gain(g[a:b].sum(), h[a:b].sum())
            gain[(left[2] < MIN_LEAF) | (right[2] < MIN_LEAF)] = -1
            k = int(np.argmax(gain))
            best = max(best, (float(gain[k]), a + k + 1))
        if best[1] < 0:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, b in itertools.pairwise(cuts):
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + L2)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree with one cut on either axis of a grid of sums."""
    def corner(v: np.ndarray) -> list[np.ndarray]:
        low = v.cumsum(0).cumsum(1)[:-1, :-1]
        top, left, all_ = v.cumsum(0)[:-1].sum(1)[:, None], v.cumsum(1)[:, :-1].sum(0)[None, :], v.sum()
        return [low, top - low, left - low, all_ - top - left + low]

    gs, hs = corner(g), corner(h)
    gain = sum(_gain(a, b) for a, b in zip(gs, hs)) - _gain(g.sum(), h.sum())
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    value = [-a[i, j] / (b[i, j] + L2) for a, b in zip(gs, hs)]
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = value
    return float(gain[i, j]), out


def fit_additive(x: np.ndarray, y: np.ndarray) -> Additive:
    """Fit to rows x with labels y (0 or 1). Without rows or with one label the model is the (smoothed) share of label 1."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    d = x.shape[1]
    edges, coarse = [_edges(x[:, f], BINS) for f in range(d)], [_edges(x[:, f], GRID) for f in range(d)]
    bins = [np.searchsorted(edges[f], x[:, f], side="right") for f in range(d)]
    cells = [np.searchsorted(coarse[f], x[:, f], side="right") for f in range(d)]
    model = Additive(float(np.log(share / (1 - share))), edges, [np.zeros(len(e) + 1) for e in edges], [], coarse, [])
    if len(np.unique(y)) < 2:
        return model
    total = np.full(len(y), model.intercept)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables)]
    for _ in range(ROUNDS):
        for f, table in enumerate(model.tables):
            g, h = slope()
            step = RATE * _tree(np.bincount(bins[f], g, len(table)), np.bincount(bins[f], h, len(table)), counts[f])
            table += step
            total += step[bins[f]]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(cells[a] * GRID + cells[b], values, GRID * GRID).reshape(GRID, GRID)

    g, h = slope()
    ranked = sorted(itertools.combinations(range(d), 2), key=lambda p: -_quadrants(grid(*p, g), grid(*p, h))[0])
    model.pairs, model.grids = ranked[:PAIRS], [np.zeros((GRID, GRID)) for _ in ranked[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(model.pairs, model.grids):
            g, h = slope()
            step = RATE * _quadrants(grid(a, b, g), grid(a, b, h))[1]
            table += step
            total += step[cells[a], cells[b]]
    return model


def fit_quality(
    docs: DataFrame, labels: DataFrame, label: Column, id_col: str = "doc_id", text_col: str = "text", where: Column | None = None,
    max_labelled: int = MAX_LABELLED,
) -> Additive:
    """Fit on max_labelled labelled rows at most (a documented bound); label: 0 or 1 over the columns of labels; where: which
    ids may be learned from. The driver gets the sampled rows' statistics, never their texts."""
    sample = labelled_sample(docs.select(id_col, F.col(text_col).cast("binary").alias("text")), labels, id_col, label.cast("int"), max_labelled, where)
    data = sample.select("label", _features("text").alias("x")).orderBy(F.xxhash64(id_col), "x", "label").toArrow()
    x = np.asarray(data.column("x").combine_chunks().flatten()).reshape(-1, len(FEATURES)) if len(data) else np.zeros((0, len(FEATURES)))
    return fit_additive(x, np.asarray(data.column("label").to_numpy(), float) if len(data) else np.zeros(0))


def _scorer(model: Additive) -> Callable:
    @F.arrow_udf(DoubleType())
    def task(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            raw = [t.as_py() for t in batch]
            parts = [model.score(features(raw[a:b])) for a, b in words.groups(raw)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return task


def score_quality(docs: DataFrame, model: Additive, text_col: str = "text", accept_at: float = 0.7) -> DataFrame:
    """docs plus score (0 to 1, probability of label 1) and predicted (1 from accept_at on, else 0).

    Columns of these names are replaced, others stay. Null and empty texts have zero statistics and get the
    score of those; repeated rows get equal scores; an empty table gives an empty one.
    """
    scored = docs.withColumn("score", _scorer(model)(F.col(text_col).cast("binary")))
    return scored.withColumn("predicted", (F.col("score") >= accept_at).cast("int"))
