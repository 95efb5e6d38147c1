"""Live settings from a stream of writes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState

from ..operators.settings import DEFAULT_DAYS
from .debounce import _interval
from .state import BUCKETS, bucket, columns, plain, wake

DAY_US = 86_400_000_000


KINDS = {"scope_id": "string", "key": "string", "us": "long", "seq": "long", "value": "string", "days": "int"}


def _latest(_: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One small record per (scope, key) of a bucket; writes may come in any order, the latest holds."""
    best = {r[:2]: r[2:] for r in zip(*(state.getOption or ()))}
    changed = {}
    for pdf in () if state.hasTimedOut else chunks:
        for scope, key, *new in zip(*[[plain(v, t) for v in pdf[c]] for c, t in KINDS.items()]):
            at = scope, key
            if at not in best or tuple(new[:2]) > best[at][:2]:
                best[at], changed[at] = tuple(new), True
    out = [(*at, None, "delete") if best[at][3] < 0 else (*at, best[at][2], "set") for at in changed]
    covered = state.getCurrentWatermarkMs() * 1000
    # A deletion is kept until no earlier write can come any more.
    ends = {at: us + max(days, 0) * DAY_US for at, (us, _, _, days) in best.items() if days}
    for at, end in ends.items():
        if end <= covered and best.pop(at)[3] > 0:
            out.append((*at, None, "expire"))
    if best:
        state.update(columns(((*at, *r) for at, r in best.items()), len(KINDS)))
        if later := [end for end in ends.values() if end > covered]:
            wake(state, min(later))
    elif state.exists:
        state.remove()
    if out:
        yield pd.DataFrame(out, columns=["scope_id", "key", "value", "op"])


def settings_stream(log: DataFrame, delay: float = 0, default_days: int = DEFAULT_DAYS, buckets: int = BUCKETS) -> DataFrame:
    """(scope_id, key, value, op) with op set, delete or expire, as writes come in and time goes on.

    State is kept per (scope, key), in buckets of these, so a scope with very many keys is spread over the cluster.
    """
    rows = log.withWatermark("ts", _interval(delay)).select(
        F.col("scope_id").cast("string").alias("scope_id"), "key", "ts", F.unix_micros("ts").alias("us"),
        F.coalesce(F.col("seq").cast("long"), F.lit(0)).alias("seq"),
        "value", F.coalesce("days", F.lit(default_days)).cast("int").alias("days"), bucket(buckets, "scope_id", "key").alias("_bucket"),
    )
    out = rows.groupBy("_bucket").applyInPandasWithState(
        _latest, "scope_id string, key string, value string, op string", ", ".join(f"{c} array<{t}>" for c, t in KINDS.items()), "update", "EventTimeTimeout"
    )
    return out.withColumn("scope_id", F.col("scope_id").cast(log.schema["scope_id"].dataType))
