"""Typed log of setting writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def setting_log(
    events: DataFrame,
    scope: Column | str = "scope_id",
    key: Column | str = "key",
    value: Column | str = "value",
    days: Column | str | None = "days",
    ts: Column | str = "ts",
    seq: Column | str | None = None,
) -> DataFrame:
    """(scope_id, key, value, days, ts, seq). The same projection serves batch and streaming input.

    `days` may be null: the default lifetime applies. `seq` orders writes of the same instant.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    return events.select(
        col(scope).alias("scope_id"),
        col(key).cast("string").alias("key"),
        col(value).cast("string").alias("value"),
        (F.lit(None) if days is None else col(days)).cast("int").alias("days"),
        col(ts).alias("ts"),
        (F.lit(0) if seq is None else col(seq)).cast("long").alias("seq"),
    )
