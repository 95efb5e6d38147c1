"""Changed values from a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .debounce import _interval
from .state import BUCKETS, InOrder


class _Changed(InOrder):
    PAYLOAD = {"value": "string", "reset": "boolean"}
    OUTPUT = {"value": "string", "us": "long", "seq": "long"}
    MEMORY = {"last": "string"}

    def first(self):
        return ("",)

    def on_rows(self, rows, memory):
        (last,) = memory
        out = []
        for us, seq, value, reset in rows:
            squeezed = (value or "").replace(" ", "")
            if squeezed and (reset or squeezed != last):
                out.append((value, us, seq))
            last = squeezed
        return out, (last,)


def changed_stream(values: DataFrame, delay: float = 0, reset: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(user_id, value, ts, seq) of each value that differs, squeezed, from the one before it.

    values is (user_id, value, ts, seq); an empty value or a true `reset` flag clears the memory.
    """
    rows = values.withWatermark("ts", _interval(delay)).select(
        "user_id", "ts", F.unix_micros("ts").alias("us"), F.coalesce(F.col("seq").cast("long"), F.lit(0)).alias("seq"), "value",
        (F.coalesce(F.col(reset), F.lit(False)) if reset else F.lit(False)).alias("reset"),
    )
    return _Changed().over(rows, "user_id", buckets).select("user_id", "value", F.timestamp_micros("us").alias("ts"), "seq")


class _ChangedBursts(StatefulProcessor):
    """Keeps the last value of a user. Bursts end in the order in which they are released, so none has to wait."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.memory = handle.getValueState("memory", "last string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        bursts = pd.concat(list(rows)).sort_values("us")
        last = self.memory.get()[0] if self.memory.exists() else ""
        kept = []
        for value, reset in zip(bursts["value"], bursts["had_reset"]):
            squeezed = (value or "").replace(" ", "")
            kept.append(bool(squeezed) and (bool(reset) or squeezed != last))
            last = squeezed
        self.memory.update((last,))
        if any(kept):
            yield bursts.loc[kept, ["user_id", "value", "us"]]

    def close(self) -> None:
        pass


def changed_bursts(bursts: DataFrame) -> DataFrame:
    """(user_id, value, ts) of each settled value that differs, squeezed, from the user's one before it.

    bursts is debounce_stream(..), in the same query. A burst is released once the watermark has passed its end, so what
    a batch releases ends later than what earlier batches released: order within the batch is enough, and a
    user's state is one value. An empty value, also inside a burst, clears the memory.

    A task opens the state of one operator only, and the bursts already lie by user_id; a struct of it as key deals
    them, a row each, to tasks of their own.
    """
    rows = bursts.select(F.struct("user_id").alias("user"), "user_id", "value", F.unix_micros("ts").alias("us"), "had_reset")
    user = bursts.schema["user_id"].dataType.simpleString()
    return rows.groupBy("user").transformWithStateInPandas(
        _ChangedBursts(), f"user_id {user}, value string, us long", "Append", "None"
    ).select("user_id", "value", F.timestamp_micros("us").alias("ts"))
