"""Event rules in batch: debounce, change detection, facets. The streams have the same results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..plans import last_known, neighbours

# Fixed value: the quiet time after which a typed query is run.
GAP_SECONDS = 0.5


def _gap(seconds: float):
    return F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))


def changed_only(
    events: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], reset: str | None = None, max_rows: int | None = None
) -> DataFrame:
    """Keep a value only if it differs from the one before it.

    Values are compared squeezed. An empty or null value is never kept and clears the memory; so does a true `reset`
    flag, which says that the memory was cleared since the row before.
    """
    text = F.coalesce(F.replace(F.col(value), F.lit(" "), F.lit("")), F.lit(""))
    rows = neighbours(events.withColumn("_v", text), keys, order, {"v": F.col("_v")}, before="_before", max_rows=max_rows)
    same = F.col("_before.v").eqNullSafe(F.col("_v"))
    changed = ~same if reset is None else (~same | F.coalesce(F.col(reset), F.lit(False)))
    return rows.where((F.col("_v") != "") & changed).drop("_v", "_before")


def debounce_batch(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], gap: float = GAP_SECONDS, ts: str = "ts", max_rows: int | None = None
) -> DataFrame:
    """Keep an event only if none follows within the gap; one exactly at the gap leaves it settled."""
    rows = neighbours(events, keys, order, {"ts": F.col(ts)}, after="_after", max_rows=max_rows)
    nxt = F.col("_after.ts")
    return rows.where(nxt.isNull() | (nxt >= F.col(ts) + _gap(gap))).drop("_after")


def settled_bursts(
    events: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], gap: float = GAP_SECONDS, ts: str = "ts", max_rows: int | None = None
) -> DataFrame:
    """(keys, value, ts, had_reset): last event of each burst, and whether the burst cleared the field.

    The batch form of streaming.debounce_stream, with bursts still open at the end included.
    """
    rows = neighbours(events, keys, order, {"ts": F.col(ts)}, before="_before", after="_after", max_rows=max_rows)
    empty = F.coalesce(F.trim(F.col(value)), F.lit("")) == ""
    starts = F.col("_before").isNull() | (F.col(ts) >= F.col("_before.ts") + _gap(gap))
    ends = F.col("_after").isNull() | (F.col("_after.ts") >= F.col(ts) + _gap(gap))
    # The last reset at or before a burst's end belongs to the burst if it lies at or after its start.
    marked = rows.withColumns({
        "_start": F.when(starts, F.struct(*order)), "_reset": F.when(empty, F.struct(*order)), "_ends": ends,
    })
    marked = last_known(marked, keys, order, ["_start", "_reset"], max_rows)
    return marked.where("_ends").select(
        *keys, value, ts, F.coalesce(F.col("_reset") >= F.col("_start"), F.lit(False)).alias("had_reset")
    )


def facet_batch(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], query: str = "q", section: str = "section_id",
    default_section: int = 0, max_rows: int | None = None
) -> DataFrame:
    """(keys, q, section_id, order..) of every search that queries and section choices set off.

    A row holds a query or a section choice, the other is null. A query runs in the section chosen
    last; a choice runs the active query again unless there is none or it is empty.
    """
    state = last_known(events, keys, order, [query, section], max_rows)
    return state.where(F.trim(F.col(query)) != "").select(
        *keys, query, F.coalesce(section, F.lit(default_section)).alias(section), *order
    )
