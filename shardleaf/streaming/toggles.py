"""Open or closed, live."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .debounce import _interval
from .state import BUCKETS, InOrder


def toggle_stream(clicks: DataFrame, initially_open: bool = False) -> DataFrame:
    """(id, is_open) after each batch, for update mode. Clicks commute, so a count is all the state."""
    odd = F.count(F.lit(1)) % 2 == 1
    return clicks.groupBy("id").agg((~odd if initially_open else odd).alias("is_open"))


class _ToggleAll(InOrder):
    PAYLOAD = {"id": "string", "is_all": "boolean"}
    OUTPUT = {"id": "string", "is_open": "boolean"}
    MEMORY = {"base": "boolean", "blocks": "array<string>", "is_open": "array<boolean>"}  # blocks clicked since the last click on all

    def __init__(self, initially_open: bool) -> None:
        self.initially_open = initially_open

    def first(self):
        return self.initially_open, [], []

    def on_rows(self, rows, memory):
        base, flipped = memory[0], dict(zip(*memory[1:]))
        touched, reset = set(), False
        for _, _, block, is_all in rows:
            if is_all:
                base, reset = not base, True
                flipped.clear()
                touched.clear()
                continue
            touched.add(block)
            flipped[block] = not flipped.get(block, base)
        out = [(None, base)] if reset else []
        out += [(b, flipped[b]) for b in sorted(touched)]
        return out, (base, list(flipped), list(flipped.values()))


def toggle_all_stream(clicks: DataFrame, delay: float = 0, initially_open: bool = True, buckets: int = BUCKETS) -> DataFrame:
    """(page_id, id, is_open); a null id speaks for every block of the page not named after it.

    clicks is (page_id, id, is_all, ts, seq): single clicks, and "toggle all" clicks whose id is null.
    """
    rows = clicks.withWatermark("ts", _interval(delay)).select(
        "page_id", "ts", F.unix_micros("ts").alias("us"), F.coalesce(F.col("seq").cast("long"), F.lit(0)).alias("seq"),
        F.col("id").cast("string").alias("id"), "is_all",
    )
    return _ToggleAll(initially_open).over(rows, "page_id", buckets)
