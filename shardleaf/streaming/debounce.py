"""Settled queries from a stream of field changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.events import GAP_SECONDS


def _interval(seconds: float) -> str:
    return f"{round(seconds * 1000)} milliseconds"


def debounce_stream(events: DataFrame, gap: float = GAP_SECONDS, delay: float = 0, seq: str = "seq") -> DataFrame:
    """(user_id, value, ts, had_reset): last value of each burst, once the gap after it has passed.

    events is (user_id, value, ts, seq). A burst is a session window; its state is one row of
    partial aggregates, so a busy user costs no memory, and rows of one user are combined on the map
    side first. Rows later than the delay are dropped.
    """
    place = F.struct(F.col("ts"), F.col(seq))
    empty = F.coalesce(F.trim(F.col("value")), F.lit("")) == ""
    return (
        events.withWatermark("ts", _interval(delay))
        .groupBy("user_id", F.session_window("ts", _interval(gap)).alias("burst"))
        .agg(
            F.max_by("value", place).alias("value"), F.max("ts").alias("last_ts"), F.max(empty).alias("had_reset")
        )
        .select("user_id", "value", F.col("last_ts").alias("ts"), "had_reset", "burst")
    )
