"""Next and previous visible item, by integer position in a group.

A window does the work. A group too big for a task is cut into chunks of about equal rows, wherever its
positions lie; between chunks only the first and last visible item of each chunk count, one row per
chunk of the groups that span a border.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..plans import cut_lineage
from ..plans.ordered import CHUNK, _carry, _spanning, split_groups


def next_prev_visible(
    items: DataFrame, keys: Sequence[str], index: str = "item_index", visible: str = "visible", max_rows: int | None = None
) -> DataFrame:
    """Add next_visible (at or after) and prev_visible (at or before) to items with a visible flag.

    The index is unique in its group, as item_index is.
    """
    shown = F.when(F.col(visible), F.col(index).cast("long"))
    rows, split = split_groups(items.withColumn("_shown", shown), keys, [index], max_rows)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(index)
    found = rows.withColumns({
        "next_visible": F.min("_shown").over(inside.rowsBetween(0, Window.unboundedFollowing)),
        "prev_visible": F.max("_shown").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
    })
    if split:
        across = Window.partitionBy(*keys).orderBy(CHUNK)
        edges = _spanning(rows.groupBy(*keys, CHUNK).agg(F.min("_shown").alias("_first"), F.max("_shown").alias("_last")), keys)
        edges = edges.select(
            *keys, CHUNK,
            F.min("_first").over(across.rowsBetween(1, Window.unboundedFollowing)).alias("_next"),
            F.max("_last").over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_prev"),
        )
        found = _carry(found, edges, keys).withColumns({
            "next_visible": F.coalesce("next_visible", "_next"), "prev_visible": F.coalesce("prev_visible", "_prev"),
        })
    return found.select(*items.columns, "next_visible", "prev_visible")


def nearest_visible(
    positions: DataFrame, items: DataFrame, keys: Sequence[str], max_rows: int | None = None
) -> DataFrame:
    """(keys, pos, next, prev) per distinct position: next item at or after it, previous at or before it.

    positions is (keys, pos), items is (keys, item_index). Both sides become one table of points, so
    this is an as-of join without a join; copies of a point are combined before the shuffle.
    """
    asked = positions.select(*keys, F.col("pos").cast("long").alias("pos"), F.lit(True).alias("asked"))
    given = items.select(*keys, F.col("item_index").cast("long").alias("pos"), F.lit(False).alias("asked"))
    points = cut_lineage(asked.unionByName(given).groupBy(*keys, "pos").agg(
        F.max("asked").alias("asked"), (~F.min("asked")).alias("visible")
    ))
    return next_prev_visible(points, keys, "pos", "visible", max_rows).where("asked").select(
        *keys, "pos", F.col("next_visible").alias("next"), F.col("prev_visible").alias("prev")
    )
