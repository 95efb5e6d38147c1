"""Connected components by contraction: every round points each node at its smallest neighbour and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans import cut_lineage


def _jump(parents: DataFrame) -> DataFrame:
    """Point each node at its parent's parent."""
    above = parents.select(F.col("node").alias("root"), F.col("root").alias("_up"))
    return parents.join(above, "root", "left").select("node", F.coalesce("_up", "root").alias("root"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of edges (a, b): root is the smallest node that links reach, itself included.

    Rows with a null end and loops are left out; an empty table gives an empty one. Each round is written
    to the shared folder, so a lost executor repeats one step. Rounds are about log of the longest chain;
    the edges of a hot node are counted with partial aggregates and joined from tables, where AQE can
    split them.
    """
    def pairs(a: str, b: str, df: DataFrame) -> DataFrame:
        return df.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()

    step, maps = cut_lineage(pairs("a", "b", edges)), []
    while not step.isEmpty():
        both = step.select("a", "b").union(step.select("b", "a"))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_min"))
        parents = cut_lineage(parents.select("node", F.least("node", "_min").alias("root")))
        parents = cut_lineage(_jump(cut_lineage(_jump(parents))))
        maps.append(parents)
        left = parents.select(F.col("node").alias("a"), F.col("root").alias("_a"))
        right = parents.select(F.col("node").alias("b"), F.col("root").alias("_b"))
        step = cut_lineage(pairs("_a", "_b", step.join(left, "a").join(right, "b")))
    if not maps:
        return step.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[0]
    for later in maps[1:]:
        later = later.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        out = out.join(later, "root", "left").select("node", F.coalesce("_up", "root").alias("root"))
    return out
