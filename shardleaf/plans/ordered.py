"""Ordered work inside groups (numbering, neighbours, last known value) that survives a hot group.

A window puts a whole group into one task. Each function first counts rows per group on the key
columns alone (a map-side combined aggregate). If the largest group fits, the plain window runs.
If not, the rows are range-partitioned on (key, order), so that a hot group spreads over as many
range partitions as it needs, and the range partition becomes the chunk. The window then runs per
(key, chunk), and what crosses a chunk border comes from a table with one row per chunk of the keys
that span a border. Such a key must start a chunk or end one, so the table has at most two rows per
chunk; what they carry may be long, so it is measured before it is broadcast.

Ties in the order are broken by a hash of the whole row, in the plain window as in the split one, so
that both see one total order and give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from .bounds import broadcast_if_small
from .durable import cut_lineage

MAX_GROUP_ROWS = 5_000_000
MAX_CHUNKS = 10_000
CHUNK = "_chunk"
TIE = "_tie"


def _total(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The frame and the order with a last column that tells different rows apart; exact copies are interchangeable."""
    return df.withColumn(TIE, F.xxhash64(*[F.to_json(c) if t.startswith("map") else F.col(c) for c, t in df.dtypes])), [*order, TIE]


def _sizes(df: DataFrame, keys: Sequence[str]) -> Row:
    return df.groupBy(*keys).count().agg(F.max("count").alias("top"), F.sum("count").alias("total")).first()


def fits(df: DataFrame, keys: Sequence[str], max_rows: int | None = None) -> bool:
    """True when no group is too big for a task."""
    return (_sizes(df, keys)["top"] or 0) <= (MAX_GROUP_ROWS if max_rows is None else max_rows)


def split_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int | None = None
) -> tuple[DataFrame, bool]:
    """Add CHUNK; also say whether any group had to be split.

    The rows are written to the shared folder before, so that a task run again draws the same salt,
    and after: range bounds come from a sample, and every later reader has to see the same ones.
    """
    limit = MAX_GROUP_ROWS if max_rows is None else max_rows
    sizes = _sizes(df, keys)
    if not sizes["top"] or sizes["top"] <= limit:
        return df.withColumn(CHUNK, F.lit(0)), False
    chunks = min(MAX_CHUNKS, max(2, math.ceil(sizes["total"] / limit)))
    # Exact copies are interchangeable, so a random last sort column may spread them.
    ranged = (
        cut_lineage(df).withColumn("_salt", F.rand(17))
        .repartitionByRange(chunks, *keys, *order, "_salt")
        .drop("_salt")
        .withColumn(CHUNK, F.spark_partition_id())
    )
    return cut_lineage(ranged), True


def _carry(rows: DataFrame, edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join what each chunk of a spanning key gets from its sibling chunks (null-safe on the keys)."""
    renamed = edges
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_k_{k}")
    renamed = renamed.withColumnRenamed(CHUNK, "_k_chunk")
    on = rows[CHUNK] == renamed["_k_chunk"]
    for k in keys:
        on = on & rows[k].eqNullSafe(renamed[f"_k_{k}"])
    return rows.join(broadcast_if_small(renamed), on, "left").drop("_k_chunk", *[f"_k_{k}" for k in keys])


def _spanning(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    return edges.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where("_n > 1").drop("_n")


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, max_rows: int | None = None
) -> DataFrame:
    """0-based position of each row in its group."""
    df, order = _total(df, order)
    rows, split = split_groups(df, keys, order, max_rows)
    w = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    result = rows.withColumn(out, F.row_number().over(w).cast("long") - 1)
    if split:
        before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        edges = _spanning(rows.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_rows")), keys)
        edges = edges.select(*keys, CHUNK, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
        result = _carry(result, edges, keys).withColumn(out, F.col(out) + F.coalesce("_offset", F.lit(0)))
        result = result.drop("_offset")
    return result.drop(CHUNK, TIE)


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], max_rows: int | None = None) -> DataFrame:
    """Replace each column by its sum over the rows of the group up to and including the row; null counts as 0."""
    df, order = _total(df.withColumns({c: F.coalesce(c, F.lit(0)) for c in cols}), order)
    rows, split = split_groups(df, keys, order, max_rows)
    w = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    result = rows.withColumns({c: F.sum(c).over(w) for c in cols})
    if split:
        before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        edges = _spanning(rows.groupBy(*keys, CHUNK).agg(*[F.sum(c).alias(c) for c in cols]), keys)
        edges = edges.select(*keys, CHUNK, *[F.sum(c).over(before).alias(f"_before_{c}") for c in cols])
        result = _carry(result, edges, keys)
        result = result.withColumns({c: F.col(c) + F.coalesce(f"_before_{c}", F.lit(0)) for c in cols})
        result = result.drop(*[f"_before_{c}" for c in cols])
    return result.drop(CHUNK, TIE)


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fields: dict[str, Column],
    before: str | None = None,
    after: str | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Add a struct of the fields of the row before and/or after in the group; null at the ends."""
    record = F.struct(*[c.alias(n) for n, c in fields.items()])
    df, order = _total(df, order)
    rows, split = split_groups(df.withColumn("_rec", record), keys, order, max_rows)
    w = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    result = rows
    if before:
        result = result.withColumn(before, F.lag("_rec").over(w))
    if after:
        result = result.withColumn(after, F.lead("_rec").over(w))
    if split:
        position = F.struct(*order)
        edges = rows.groupBy(*keys, CHUNK).agg(
            F.min_by("_rec", position).alias("_first"), F.max_by("_rec", position).alias("_last")
        )
        border = Window.partitionBy(*keys).orderBy(CHUNK)
        edges = _spanning(edges, keys).select(
            *keys, CHUNK, F.lag("_last").over(border).alias("_from_left"),
            F.lead("_first").over(border).alias("_from_right"),
        )
        result = _carry(result, edges, keys)
        if before:
            result = result.withColumn(before, F.coalesce(before, "_from_left"))
        if after:
            result = result.withColumn(after, F.coalesce(after, "_from_right"))
        result = result.drop("_from_left", "_from_right")
    return result.drop("_rec", CHUNK, TIE)


def last_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], max_rows: int | None = None
) -> DataFrame:
    """Replace each column by its last non-null value up to and including the row."""
    df, order = _total(df, order)
    rows, split = split_groups(df, keys, order, max_rows)
    w = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    result = rows.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    if split:
        position = F.struct(*order)
        edges = rows.groupBy(*keys, CHUNK).agg(
            *[F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in cols]
        )
        left = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        edges = _spanning(edges, keys).select(
            *keys, CHUNK, *[F.last(c, ignorenulls=True).over(left).alias(f"_left_{c}") for c in cols]
        )
        result = _carry(result, edges, keys)
        result = result.withColumns({c: F.coalesce(c, f"_left_{c}") for c in cols})
        result = result.drop(*[f"_left_{c}" for c in cols])
    return result.drop(CHUNK, TIE)
