"""Quality rules with robust multivariate outliers: minimum covariance determinant per language and source.

Each text gets counts, two fixed base rules, and a vector of transformed statistics. Per language and
source the centre and covariance of the vectors are those of the subset with the smallest determinant
that concentration steps reach: keep the (n + d + 1) / 2 of n texts that are nearest by Mahalanobis distance, so that nearly half may
be bad, estimate again, repeat. The start are medians with median deviations; the end is
estimated once more from all texts that it takes for regular. A text is rejected when its distance to the final estimate is beyond a
chi-square quantile.

All texts take part in every step. A step is one aggregate: moments per group and distance bin (bins a
twelfth of a doubling wide), partially combined before the shuffle, then summed up to the bin in which
the number is reached, which counts in proportion. Groups are never gathered, however large.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from ..plans import broadcast_if_small, cut_lineage
from . import words
from .stats import base_statistics

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_GROUP = 50
STEPS = 6
REGULAR = 0.975
TAIL = 1e-6
#: Least standard deviation of each statistic: what differs by less is never told apart.
FLOORS = {"word_length": 0.05, "symbols": 0.15, "distinct": 0.03, "echo": 0.08, "capitals": 0.04}
DIM = len(FLOORS)
NAMES = list(FLOORS)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct", "n_echo", "n_upper")


def chi2_quantile(p: float, d: int) -> float:
    """Wilson-Hilferty approximation."""
    c = 2 / (9 * d)
    return d * (1 - c + NormalDist().inv_cdf(p) * math.sqrt(c)) ** 3


@F.arrow_udf(StructType([StructField(c, LongType()) for c in COUNTS]))
def _counts(texts: pa.Array) -> pa.Array:
    raw = [t.as_py() for t in texts]
    parts = [base_statistics(raw[a:b]) for a, b in words.groups(raw)]
    cols = [pa.array(np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64), pa.int64()) for c in COUNTS]
    return pa.StructArray.from_arrays(cols, list(COUNTS))


def text_counts(text: str | Column) -> Column:
    """Struct of the counts of COUNTS over a whole text; null counts as a text without words."""
    return _counts((F.col(text) if isinstance(text, str) else text).cast("binary"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def statistics() -> dict[str, Column]:
    """Transformed statistics: logs and square roots of rates, so that they scatter about evenly."""
    n, chars = F.greatest(F.lit(1.0), "n_words"), F.greatest(F.lit(1.0), "word_chars")
    return {
        "word_length": F.log(chars / n), "symbols": F.log1p(10 * F.col("n_symbols") / n),
        "distinct": F.log1p("n_distinct") / F.log1p(n), "echo": F.sqrt(F.col("n_echo") / n), "capitals": F.sqrt(F.col("n_upper") / chars),
    }


def _distance() -> Column:
    """Squared Mahalanobis distance to (centre, inverse)."""
    off = [F.col(c) - F.get("centre", F.lit(i)) for i, c in enumerate(NAMES)]
    out = F.lit(0.0)
    for i in range(DIM):
        for j in range(i, DIM):
            out = out + (1 if i == j else 2) * F.get("inverse", F.lit(i * DIM + j)) * off[i] * off[j]
    return F.greatest(out, F.lit(0.0))


def _moments() -> list[Column]:
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(NAMES)]
    products = [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"p{i}_{j}") for i in range(DIM) for j in range(i, DIM)]
    return [F.count(F.lit(1)).alias("n"), *sums, *products]


_SUMS = ["n"] + [f"s{i}" for i in range(DIM)] + [f"p{i}_{j}" for i in range(DIM) for j in range(i, DIM)]
_ESTIMATE = StructType([StructField("centre", ArrayType(DoubleType())), StructField("inverse", ArrayType(DoubleType())), StructField("logdet", DoubleType())])


def _solver(inflate: float | None) -> Callable:
    """Centre, inverse covariance and log determinant from summed moments and the number of all texts; the floors keep
    every matrix regular. Without inflate the covariance is scaled by the share of all texts that the moments are of."""
    @F.arrow_udf(_ESTIMATE)
    def task(sums: pa.Array) -> pa.Array:
        out = []
        for row in sums.to_pylist():
            n, rest, share = row[0], np.array(row[1:-1]), row[0] / row[-1]
            scale = inflate or (share / _kept_variance(share, DIM) if share < 1 else 1.0)
            centre, cov = rest[:DIM] / n, np.zeros((DIM, DIM))
            cov[np.triu_indices(DIM)] = rest[DIM:] / n
            cov = cov + np.triu(cov, 1).T - np.outer(centre, centre)
            cov = (cov + cov.T) / 2
            values, vectors = np.linalg.eigh(cov)
            cov = (vectors * np.maximum(values, 0)) @ vectors.T * scale + np.diag(np.array([*FLOORS.values()]) ** 2)
            out.append({"centre": centre.tolist(), "inverse": np.linalg.inv(cov).ravel().tolist(), "logdet": float(np.linalg.slogdet(cov)[1])})
        return pa.array(out, pa.struct([("centre", pa.list_(pa.float64())), ("inverse", pa.list_(pa.float64())), ("logdet", pa.float64())]))

    return task


def _estimates(sums: DataFrame, keys: list[str], inflate: float | None, all_: str = "n") -> DataFrame:
    as_array = F.array(*[F.col(c).cast("double") for c in [*_SUMS, all_]])
    return sums.select(*keys, _solver(inflate)(as_array).alias("_e")).select(*keys, "_e.*")


def _with_cells(rows: DataFrame) -> DataFrame:
    """Add cell: a language and source with MIN_GROUP texts has its own; smaller ones of a language go together, and what is
    still smaller goes into one cell for all."""
    def sizes(df: DataFrame, *keys: str) -> DataFrame:
        return cut_lineage(df.groupBy(*keys).agg(F.sum("_n").alias("_n")))

    pairs = cut_lineage(rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("_n")))
    small = sizes(pairs.where(F.col("_n") < MIN_GROUP), "lang").where(F.col("_n") >= MIN_GROUP).select(F.col("lang").alias("_lang"), F.lit(True).alias("_pooled"))
    named = pairs.join(small, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    cell = F.when(F.col("_n") >= MIN_GROUP, F.struct(F.lit(2).alias("level"), "lang", "source"))
    cell = cell.when(F.col("_pooled"), F.struct(F.lit(1).alias("level"), "lang", F.lit(None).cast("string").alias("source")))
    cell = cell.otherwise(F.struct(F.lit(0).alias("level"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source")))
    named = cut_lineage(named.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), F.xxhash64(F.to_json(cell)).alias("cell")))
    on = F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s"))
    return rows.join(broadcast_if_small(named), on, "left").drop("_l", "_s")


def fit_mcd(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """(cell, centre, inverse) for rows with a cell and the statistics: scaled so that distances in a normal cloud follow chi-square."""
    # Start: medians with median deviations. Plain moments are none: from there the steps can end at copies of one text.
    middle = cut_lineage(rows.groupBy("cell").agg(*[F.percentile_approx(c, 0.5, 1000).alias(f"m_{c}") for c in NAMES]))
    off = rows.join(broadcast_if_small(middle), "cell")
    spread = off.groupBy("cell").agg(
        *[F.first(f"m_{c}").alias(f"m_{c}") for c in NAMES],
        *[F.percentile_approx(F.abs(F.col(c) - F.col(f"m_{c}")), 0.5, 1000).alias(f"d_{c}") for c in NAMES],
    )
    variances = [F.pow(1.4826 * F.col(f"d_{c}"), 2) + FLOORS[c] ** 2 for c in NAMES]
    inverse = F.array(*[(1 / variances[i]) if i == j else F.lit(0.0) for i in range(DIM) for j in range(DIM)])
    robust = spread.select("cell", F.array(*[f"m_{c}" for c in NAMES]).alias("centre"), inverse.alias("inverse"), F.lit(0.0).alias("logdet"))
    found = cut_lineage(robust)
    for _ in range(steps):
        near = rows.join(broadcast_if_small(found.drop("logdet")), "cell").withColumn("_d", _distance())
        near = near.withColumn("_bin", F.when(F.col("_d") < 1e-6, -240).otherwise(F.floor(12 * F.log2("_d"))).cast("int"))
        bins = cut_lineage(near.groupBy("cell", "_bin").agg(*_moments()))
        upto = Window.partitionBy("cell").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        all_ = Window.partitionBy("cell")
        inner = bins.withColumns({"_before": F.coalesce(F.sum("n").over(upto), F.lit(0)), "_all": F.sum("n").over(all_)})
        need = F.least(F.floor((F.col("_all") + DIM + 1) / 2), "_all")
        inner = inner.withColumn("_part", F.least(F.lit(1.0), (need - F.col("_before")) / F.col("n"))).where("_part > 0")
        sums = inner.groupBy("cell").agg(*[F.sum(F.col("_part") * F.col(c)).alias(c) for c in _SUMS], F.first("_all").alias("_all"))
        found = cut_lineage(_estimates(sums, ["cell"], None, "_all"))
    best = cut_lineage(found.select("cell", "centre", "inverse"))
    # One reweighting step: the moments of all texts that the raw estimate takes for regular.
    regular = rows.join(broadcast_if_small(best), "cell").where(_distance() <= chi2_quantile(REGULAR, DIM))
    final = _estimates(regular.groupBy("cell").agg(*_moments()), ["cell"], REGULAR / _kept_variance(REGULAR, DIM))
    final = cut_lineage(final.select("cell", F.col("centre").alias("_centre"), F.col("inverse").alias("_inverse")))
    return cut_lineage(best.join(final, "cell", "left").select(
        "cell", F.coalesce("_centre", "centre").alias("centre"), F.coalesce("_inverse", "inverse").alias("inverse")
    ))


def _kept_variance(share: float, d: int) -> float:
    """Share of the variance that the nearest `share` of a normal cloud has: P(chi2 with d + 2 degrees <= quantile of d)."""
    q = chi2_quantile(share, d)
    c = 2 / (9 * (d + 2))
    return NormalDist().cdf(((q / (d + 2)) ** (1 / 3) - 1 + c) / math.sqrt(c))


def quality_rules(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", keep: tuple[str, ...] = ("doc_id",), tail: float = TAIL
) -> DataFrame:
    """The columns of `keep` plus the counts, base_failed, distance (squared; null if base_failed) and kept.

    base_failed: under 20 words, or over 30 % of the words in 8-word windows that the text repeats. Texts
    that pass the base rules make the estimates; kept texts are those of them that lie within the chi-square
    quantile 1 - tail. Null texts count as empty and fail. A null language or source is a value of its own.
    Repeated rows each give a row; an empty table gives an empty one. Columns of `keep` must not have the names
    of added columns; other columns are not read.
    """
    kept = [F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), text_counts(text_col).alias("_c"))
    rows = rows.select(*[f"_keep_{i}" for i in range(len(keep))], "lang", "source", "_c.*")
    rows = cut_lineage(rows.withColumns(statistics()).withColumn("base_failed", base_failed()))
    passed = cut_lineage(_with_cells(rows.where("NOT base_failed")))
    fitted = fit_mcd(passed.select("cell", *NAMES))
    placed = passed.join(broadcast_if_small(fitted), "cell", "left").withColumn("distance", _distance())
    names = [F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)]
    counts = [*names, *COUNTS, "base_failed"]
    good = placed.select(*counts, "distance", (F.col("distance") <= chi2_quantile(1 - tail, DIM)).alias("kept"))
    bad = rows.where("base_failed").select(*counts, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return good.unionByName(bad)
