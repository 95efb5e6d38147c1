"""What lies under a prefix, by rank arithmetic: rows that start with a prefix are neighbours in sorted order.

Rows and the two ends of every prefix are sorted together once, and running sums over the rows are read off at
both ends. The difference is the sum over the prefix, the value at its lower end the rank of its first row. No row is
copied for the prefixes that it may have, and a long prefix costs what a short one does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .durable import cut_lineage
from .ordered import running_sums

AFTER_ALL = b"\xff"  # no byte of UTF-8: it sorts after every continuation


def prefix_ranges(
    rows: DataFrame, wanted: DataFrame, keys: Sequence[str], place: str, prefix: str, sums: Sequence[str] = (), strict: bool = False,
    max_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Ranks (keys, place, rank) of the rows, and ranges (keys, prefix, first, n_rows, sums..) of the wanted prefixes.

    rows (keys, place, sums) are distinct in (keys, place), wanted in (keys, prefix). Ranks count from 0 within the
    keys, in the order of bytes; a range is rank first and the n_rows - 1 after it, and the sums are over these rows.
    With `strict` a row that equals the prefix is not in its range. A group of any size is split. Null sums count as 0.
    """
    tallies = ["_row", *sums]
    row = rows.select(*keys, F.col(place).alias("_text"), F.encode(place, "utf-8").alias("_place"), F.lit(1).alias("_kind"), F.lit(1).cast("long").alias("_row"), *sums)
    none = [F.lit(0).cast("long").alias("_row"), *[F.lit(0).cast(rows.schema[s].dataType).alias(s) for s in sums]]
    ends = [(F.encode(prefix, "utf-8"), 2 if strict else 0), (F.concat(F.encode(prefix, "utf-8"), F.lit(AFTER_ALL)), 3)]
    for at, kind in ends:
        row = row.unionByName(wanted.select(*keys, F.col(prefix).alias("_text"), at.alias("_place"), F.lit(kind).alias("_kind"), *none))
    done = cut_lineage(running_sums(cut_lineage(row), keys, ["_place", "_kind"], tallies, max_rows).drop("_place"))
    ranks = done.where("_kind = 1").select(*keys, F.col("_text").alias(place), (F.col("_row") - 1).alias("rank"))
    sign = F.when(F.col("_kind") == 3, 1).otherwise(-1)
    ranges = done.where("_kind <> 1").groupBy(*keys, F.col("_text").alias(prefix)).agg(
        F.min("_row").alias("first"), *[F.sum(sign * F.col(t)).alias("n_rows" if t == "_row" else t) for t in tallies]
    )
    return ranks, ranges
