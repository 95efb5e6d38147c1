"""Shared base of the stateful operators that need event order.

Rows wait in the state of their key until the watermark has passed them and are then handled in order. What is
held per key is bounded by the rows of that key within the watermark delay and one batch. Batches are
bounded by the source (files per trigger).

Keys share buckets by their hash, and the state of a bucket comes with its rows and goes back with the results: one call and
one pandas frame per bucket and batch, not per key. A bucket's state is written anew when one of its keys has rows; many
millions of keys want more buckets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState

BUCKETS = 4096


class InOrder:
    """Input rows are (key, us, seq, payload..): microseconds, order within an instant, columns of PAYLOAD."""

    PAYLOAD: dict[str, str] = {}
    MEMORY: dict[str, str] = {}  # what outlives a batch, per key
    OUTPUT: dict[str, str] = {}  # after the key

    def first(self) -> tuple:
        """The memory of a new key."""
        raise NotImplementedError

    def on_rows(self, rows: list[tuple], memory: tuple) -> tuple[list[tuple], tuple]:
        """Output rows for a key's (us, seq, payload..) that are in order and complete, and the memory after them."""
        raise NotImplementedError

    def over(self, rows: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
        """(key, output..) of all keys; rows has a watermark."""
        self.key, kind = key, rows.schema[key].dataType
        held = {"held_key": "string", "us": "long", "seq": "long"} | {f"held_{c}": t for c, t in self.PAYLOAD.items()}
        state = held | {"known": "string"} | {f"memory_{c}": t for c, t in self.MEMORY.items()}
        rows = rows.withColumns({key: F.col(key).cast("string"), "_bucket": bucket(buckets, key)})
        out = rows.groupBy("_bucket").applyInPandasWithState(
            self._step, ", ".join(f"{c} {t}" for c, t in ({key: "string"} | self.OUTPUT).items()),
            ", ".join(f"{c} array<{t}>" for c, t in state.items()), "append", "EventTimeTimeout",
        )
        return out.withColumn(key, F.col(key).cast(kind))

    def _step(self, _: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, m = 3 + len(self.PAYLOAD), len(self.MEMORY)
        kept = state.getOption or ((),) * (n + 1 + m)
        held, memory = list(zip(*kept[:n])), dict(zip(kept[n], zip(*kept[n + 1 :])))
        kinds = {self.key: "string", "us": "long", "seq": "long"} | self.PAYLOAD
        for pdf in () if state.hasTimedOut else chunks:
            held += zip(*[[plain(v, t) for v in pdf[c]] for c, t in kinds.items()])
        covered = state.getCurrentWatermarkMs() * 1000
        ready, later = [r for r in held if r[1] <= covered], [r for r in held if r[1] > covered]
        ready.sort(key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
        out = []
        for key, rows in groupby(ready, key=lambda r: r[0]):
            found, memory[key] = self.on_rows([r[1:] for r in rows], memory.get(key) or self.first())
            out += [(key, *r) for r in found]
        state.update((*columns(later, n), list(memory), *columns(memory.values(), m)))
        if later:
            wake(state, min(r[1] for r in later))
        if out:
            yield pd.DataFrame(out, columns=[self.key, *self.OUTPUT])


def bucket(buckets: int, *keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def columns(rows: Iterable[tuple], n: int) -> list[list]:
    """The n columns of rows, as lists."""
    return [list(c) for c in zip(*rows)] or [[] for _ in range(n)]


def wake(state: GroupState, us: int) -> None:
    """Call again once the watermark has reached this time; a timeout comes only after it has passed the one that is set."""
    state.setTimeoutTimestamp(max(1, -(-us // 1000) - 1))


PYTHON = {"string": str, "int": int, "long": int, "boolean": bool}


def plain(value, kind: str):
    """State takes Python values of the declared type. pandas turns null into NaN and then int into float."""
    return None if value is None or value != value else PYTHON[kind](value)
