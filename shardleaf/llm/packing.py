"""Packing by optimal length buckets: dynamic programming over the global histogram, batches under a token budget.

Texts of a batch are padded to the length bound of their bucket. The bounds that pad least are found
exactly, for at most `buckets` buckets, by dynamic programming over the histogram of all lengths. The
histogram has a bounded number of bins: lengths below 4096 are exact, longer ones keep 12 leading bits
(about 2000 bins per doubling), each bin with its largest length, so padding is never under-counted.

Batches form inside each bucket: its texts are numbered in an order fixed by a hash of their ids, and
every `budget // bound` of them are a batch. Numbering is split into ranges of the hash, so a bucket
with a third of all rows is no single task's work.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..plans import cut_lineage
from .columns import restore, set_aside
from .mixing import RANGE_BITS, _starts, order_key

BUCKETS = 8
TOKEN_BUDGET = 16_384
EXACT = 4096


@dataclass
class Buckets:
    """bounds: ascending padded lengths; padding: of all texts together, in tokens."""

    bounds: list[int]
    padding: int


def length_bin(n: Column) -> Column:
    """Upper end of the histogram bin of a length."""
    shift = F.greatest(F.lit(0), F.length(F.bin(n)) - 12)
    unit = F.pow(F.lit(2.0), shift).cast("long")
    return F.when(n < EXACT, n).otherwise(F.ceil(n / unit) * unit).cast("long")


def best_bounds(lengths: np.ndarray, counts: np.ndarray, totals: np.ndarray, buckets: int) -> Buckets:
    """Cut points that pad least. lengths: ascending largest lengths of the bins; counts and totals of their texts.

    cost(i, j) = lengths[j] * texts in i..j - tokens in i..j, which satisfies the quadrangle inequality, so
    the best first bin of the last bucket never moves back as j grows: each layer is divide and conquer.
    """
    b = len(lengths)
    if not b:
        return Buckets([], 0)
    n, t = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(totals)])
    best = lengths * n[1:] - t[1:]  # one bucket over bins 0..j
    choice = [np.zeros(b, np.int64)]
    for _ in range(1, min(buckets, b)):
        now, cut = best.copy(), np.zeros(b, np.int64)
        before = np.concatenate([[0], best[:-1]])  # cost of all bins before i
        stack = [(0, b - 1, 0, b - 1)]
        while stack:
            lo, hi, first, last = stack.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(first, min(j, last) + 1)
            costs = before[i] + lengths[j] * (n[j + 1] - n[i]) - (t[j + 1] - t[i])
            k = int(np.argmin(costs))
            now[j], cut[j] = costs[k], i[k]
            stack += [(lo, j - 1, first, int(i[k])), (j + 1, hi, int(i[k]), last)]
        choice.append(cut)
        best = now
    bounds, j = [], b - 1
    for cut in reversed(choice):
        if j < 0:
            break
        bounds.append(int(lengths[j]))
        j = int(cut[j]) - 1
    return Buckets(bounds[::-1], int(best[-1]))


def fit_buckets(docs: DataFrame, length_col: str, buckets: int = BUCKETS) -> Buckets:
    """Best bounds for all lengths above 0. The driver gets one row per histogram bin, a bounded number."""
    n = F.col(length_col).cast("long")
    rows = docs.select(n.alias("n")).where("n > 0").groupBy(length_bin(F.col("n")).alias("bin")).agg(
        F.max("n").alias("top"), F.count(F.lit(1)).alias("rows"), F.sum("n").alias("tokens")
    ).orderBy("bin").toPandas()
    return best_bounds(*(rows[c].to_numpy(np.int64) for c in ("top", "rows", "tokens")), buckets)


def pack(
    docs: DataFrame, length_col: str, id_col: str = "doc_id", buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, fitted: Buckets | None = None
) -> DataFrame:
    """docs plus bucket, bucket_length, batch, place and padding (columns of these names are replaced, others stay).

    A batch holds up to budget // bucket_length texts of one bucket, at least one, each padded to
    bucket_length; so only a text longer than the budget makes a batch over it, alone. Texts of null or no length go to bucket 0
    of length 0, one batch without padding. batch is a number within the bucket. Rows with
    one id and length are interchangeable. An empty table gives an empty one.
    """
    names = docs.drop("bucket", "bucket_length", "batch", "place", "padding").columns
    n = F.coalesce(F.col(length_col).cast("long"), F.lit(0))
    rows = cut_lineage(set_aside(docs.select(*[docs[c] for c in names]), n=n, id=F.col(id_col), key=order_key(id_col)))
    bounds = [0, *(fitted or fit_buckets(rows, "n", buckets)).bounds]
    n = F.col("n")
    bucket = F.lit(0)
    for b in range(1, len(bounds)):
        bucket = F.when(n > bounds[b - 1], b).otherwise(bucket)
    sizes = F.array(*[F.lit(x).cast("long") for x in bounds])
    rows = rows.withColumn("bucket", bucket)
    rows = rows.withColumn("bucket_length", F.get(sizes, "bucket")).withColumn("range", F.shiftright("key", 60 - RANGE_BITS))
    rows = _starts(rows, "bucket", "range", ["key", "id", "n"], F.lit(1).cast("long"), "number")
    capacity = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest(F.lit(1).cast("long"), "bucket_length")))
    batch = F.when(F.col("bucket") == 0, F.lit(0)).otherwise(F.floor(F.col("number") / capacity)).cast("long")
    place = F.when(F.col("bucket") == 0, F.col("number")).otherwise(F.col("number") % capacity)
    padding = F.col("bucket_length") - n
    return restore(rows, names, bucket=F.col("bucket"), bucket_length=F.col("bucket_length"), batch=batch, place=place, padding=padding)
