"""Toxicity as ordered severity grades: cumulative-link regression on sparse text features.

P(grade > k) = sigmoid(score - threshold k) with one weight vector for all thresholds. The features of
a text are its distinct words and the first 4 and 5 bytes of its words, in lower case, as hashes. The
model is fitted on a bounded sample of labelled rows: Spark counts each feature in clean and in graded
texts, the ones that tell the two apart are kept (a bounded number), and only the kept features of the
sampled texts come to the driver. Scoring reads every text whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from . import words
from .columns import restore, set_aside
from .samples import labelled_sample

MAX_LABELLED = 12_000
MAX_FEATURES = 8_192
PREFIXES = (4, 5)
MIN_TEXTS = 4
MIN_CHI2 = 15.0


@dataclass
class OrdinalModel:
    """features: sorted hashes; weights: one each; thresholds: ascending, one per grade above 0."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold, one column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))


def features(block: words.Block) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature hash) of each word and word prefix; with repeats."""
    found = [block.hashes(0, words.LOWER)]
    for size in PREFIXES:
        found.append(words.span_hashes(block.buf, block.starts, np.minimum(block.starts + size, block.ends), size, words.LOWER))
    return np.tile(block.owner, len(found)), np.concatenate(found)


def _kept(text: np.ndarray, hashes: np.ndarray, features_: np.ndarray, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, position in features_) pairs of the hashes that are among features_."""
    near = np.flatnonzero(sieve[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
    at = np.minimum(np.searchsorted(features_, hashes[near]), max(0, len(features_) - 1))
    hit = features_[at] == hashes[near] if len(features_) else np.zeros(0, bool)
    pairs = np.unique(text[near][hit] * np.int64(len(features_) + 1) + at[hit])
    return pairs // (len(features_) + 1), pairs % (len(features_) + 1)


def _sieve(features_: np.ndarray) -> np.ndarray:
    sieve = np.zeros(1 << 16, bool)
    sieve[(features_ & np.uint64(0xFFFF)).astype(np.int64)] = True
    return sieve


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, clean, graded): texts of a block with the feature, by label 0 or above."""
    for batch in batches:
        texts, graded = [t.as_py() for t in batch.column("text")], batch.column("label").to_numpy() > 0
        for a, b in words.groups(texts):
            text, h = features(words.block(texts[a:b], words.PUNCTUATION))
            order = np.lexsort((text, h))
            text, h = text[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
            h, yes = h[new], graded[a:b][text[new]]
            kinds, at = np.unique(h, return_inverse=True)
            n, g = np.bincount(at, minlength=len(kinds)), np.bincount(at, yes, len(kinds)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(n - g), pa.array(g)], ["feature", "clean", "graded"])


def _telling(sample: DataFrame) -> np.ndarray:
    """Sorted hashes of the features whose chi-square between clean and graded texts is high; MAX_FEATURES at most."""
    total = sample.agg(F.sum(F.expr("IF(label > 0, 0, 1)")).alias("clean"), F.sum(F.expr("IF(label > 0, 1, 0)")).alias("graded")).first()
    clean, graded = float(total["clean"] or 0), float(total["graded"] or 0)
    if not clean or not graded:
        return np.zeros(0, np.uint64)
    counts = sample.select("text", "label").mapInArrow(_counted, "feature long, clean long, graded long")
    counts = counts.groupBy("feature").agg(F.sum("clean").cast("double").alias("c"), F.sum("graded").cast("double").alias("g"))
    n, a, b = clean + graded, F.col("g"), F.col("c")
    cross = a * clean - b * graded
    chi2 = n * cross * cross / ((a + b) * (n - a - b + 0.5) * clean * graded)
    best = counts.where((a + b >= MIN_TEXTS) & (chi2 >= MIN_CHI2)).orderBy(chi2.desc(), "feature").limit(MAX_FEATURES)
    rows = best.select("feature").toPandas()
    return np.sort(rows["feature"].to_numpy(np.int64).view(np.uint64))


def _selected(features_: np.ndarray) -> Callable:
    sieve = _sieve(features_)

    @F.arrow_udf(ArrayType(IntegerType()))
    def task(texts: pa.Array) -> pa.Array:
        raw, out = [t.as_py() for t in texts], []
        for a, b in words.groups(raw):
            text, at = _kept(*features(words.block(raw[a:b], words.PUNCTUATION)), features_, sieve)
            out += [x.astype(np.int32) for x in np.split(at, np.searchsorted(text, np.arange(1, b - a)))]
        return pa.array(out, pa.list_(pa.int32()))

    return task


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_features: int, l2: float = 1e-3, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the cumulative-link model by full gradient steps (Adam) on the log likelihood.

    rows: distinct feature positions per text. Thresholds are the first one plus positive gaps.
    """
    k = int(grades.max()) if len(grades) else 0
    n = len(grades)
    sizes = np.fromiter(map(len, rows), np.int64, n)
    text = np.repeat(np.arange(n), sizes)
    at = np.concatenate(rows).astype(np.int64) if sizes.sum() else np.zeros(0, np.int64)
    share = np.array([(np.sum(grades > j) + 0.5) / (n + 1) for j in range(k)])
    first = np.log((1 - share) / share)
    gaps = np.log(np.maximum(np.diff(first), 0.05))
    p = np.concatenate([np.zeros(n_features), first[:1], gaps])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, t = p[:n_features], np.cumsum(np.concatenate([p[n_features : n_features + 1], np.exp(p[n_features + 1 :])]))
        score = np.bincount(text, w[at], n)
        cdf = 1 / (1 + np.exp(np.clip(score[:, None] - t[None, :], -500, 500)))  # P(grade <= j)
        cdf = np.concatenate([np.zeros((n, 1)), cdf, np.ones((n, 1))], 1)
        low, high = cdf[np.arange(n), grades], cdf[np.arange(n), grades + 1]
        mass = np.maximum(high - low, 1e-12)
        d_low, d_high = low * (1 - low) / mass, high * (1 - high) / mass
        d_score = (d_high - d_low) / n  # of the negative log likelihood
        grad = np.zeros_like(p)
        grad[:n_features] = np.bincount(at, d_score[text], n_features) + l2 * w
        d_t = np.zeros(k + 2)
        np.add.at(d_t, grades, d_low / n)
        np.add.at(d_t, grades + 1, -d_high / n)
        d_t = d_t[1 : k + 1]
        grad[n_features] = d_t.sum()
        grad[n_features + 1 :] = [d_t[j:].sum() * np.exp(p[n_features + j]) for j in range(1, k)]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p[:n_features], np.cumsum(np.concatenate([p[n_features : n_features + 1], np.exp(p[n_features + 1 :])]))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, grade: Column, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED
) -> OrdinalModel:
    """Fit on max_labelled labelled rows at most (a documented bound); grade: whole numbers from 0 over labels' columns.

    Without two grades among the labels the model gives every text the one grade there is (0 if none).
    """
    sample = labelled_sample(docs.select(id_col, F.col(text_col).cast("binary").alias("text")), labels, id_col, grade.cast("int"), max_labelled)
    kept = _telling(sample)
    data = sample.select("label", _selected(kept)("text").alias("at")).toArrow()
    grades = data.column("label").to_numpy().astype(np.int64)
    if len(np.unique(grades)) < 2:
        top = int(grades.max()) if len(grades) else 0
        return OrdinalModel(kept[:0], np.zeros(0), np.concatenate([np.full(top, -500.0), [500.0]]))
    rows = [np.asarray(x) for x in data.column("at").to_pylist()]
    weights, thresholds = fit_ordinal(rows, grades, len(kept))
    return OrdinalModel(kept, weights, thresholds)


_SCORE = StructType([StructField("severity", DoubleType()), StructField("p_toxic", DoubleType()), StructField("grade", IntegerType())])


def _scorer(model: OrdinalModel) -> Callable:
    sieve = _sieve(model.features)

    @F.arrow_udf(_SCORE)
    def task(texts: pa.Array) -> pa.Array:
        raw, scores = [t.as_py() for t in texts], [np.zeros(0)]
        for a, b in words.groups(raw):
            text, at = _kept(*features(words.block(raw[a:b], words.PUNCTUATION)), model.features, sieve)
            scores.append(np.bincount(text, model.weights[at], b - a) if len(at) else np.zeros(b - a))
        above = model.above(np.concatenate(scores))
        cols = [above.sum(1), above[:, 0], (above >= 0.5).sum(1).astype(np.int32)]
        return pa.StructArray.from_arrays([pa.array(c) for c in cols], ["severity", "p_toxic", "grade"])

    return task


def score_toxicity(docs: DataFrame, model: OrdinalModel, text_col: str = "text", reject_at: float = 0.5) -> DataFrame:
    """docs plus severity (expected grade), p_toxic (of a grade above 0), grade (the median one) and rejected.

    Columns of these names are replaced, others stay. Null and empty texts have no features and get the
    scores of the thresholds alone; repeated rows get equal scores; an empty table gives an empty one.
    """
    scored = set_aside(docs, score=_scorer(model)(F.col(text_col).cast("binary")))
    new = {c: F.col("score").getField(c) for c in ("severity", "p_toxic", "grade")}
    return restore(scored, docs.columns, **new, rejected=F.col("score.p_toxic") >= reject_at)


def without_toxic(docs: DataFrame, model: OrdinalModel, text_col: str = "text", reject_at: float = 0.5) -> DataFrame:
    """The rows of docs that score_toxicity does not reject, with the columns they have."""
    scored = set_aside(docs, score=_scorer(model)(F.col(text_col).cast("binary")))
    return restore(scored.where(F.col("score.p_toxic") < reject_at), docs.columns)
