"""Broadcasts that are checked before they are asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MAX_ROWS = 200_000
MAX_BYTES = 64 * 1024 * 1024


def is_small(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """True when the whole frame has at most max_rows rows and about max_bytes bytes.

    The probe stops at max_rows + 1 rows, so a big frame is not read to the end.
    """
    probe = (
        df.limit(max_rows + 1)
        .select(F.octet_length(F.to_json(F.struct("*"))).cast("long").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b"))
        .first()
    )
    return probe["n"] <= max_rows and probe["b"] <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Hint a broadcast for a frame that passes the size check; leave any other to Catalyst and AQE,
    which then shuffle it and split skewed keys."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df
