"""Trees whose row ids encode the path: levels, children, descendants, rollups, open/closed state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import tree as t
from ..plans import cut_lineage, prefix_ranges

MAX_TREE_ROWS = 1_000_000  # a tree with more rows is sorted in parts
BLOCK = 64  # ranks

def tree_paths(tree: DataFrame) -> DataFrame:
    """Add depth, parent and ancestors to rows with an id; narrow."""
    i = F.col("id")
    return tree.withColumns({"depth": t.depth(i), "parent": t.parent(i), "ancestors": t.ancestors(i)})


def level_filter(tree: DataFrame, level: int, keep_hidden: bool = False) -> DataFrame:
    """(id, state) after expanding to a level: open above it, closed on it; deeper rows are hidden."""
    depth = t.depth(F.col("id"))
    state = F.when(depth < level, "open").when(depth == level, "closed").otherwise("hidden")
    rows = tree if keep_hidden else tree.where(depth <= level)
    return rows.select("id", state.alias("state"))


def tree_children(paths: DataFrame) -> DataFrame:
    """(id, child_id) for every row of the tree and the rows one level below it.

    The child knows its parent, so the tree itself is only asked whether that parent exists.
    """
    pairs = paths.where("parent is not null").select(F.col("parent").alias("id"), F.col("id").alias("child_id"))
    return pairs.join(paths.select("id"), "id", "left_semi")


def tree_descendants(paths: DataFrame, max_rows: int | None = None) -> DataFrame:
    """(id, descendant_id) for every row of the tree and all rows below it; rows with one id are one row.

    Sorted by id, what is below a row is a range of ranks. Ranges are cut at every BLOCK ranks and meet the rows of
    the block, so a row is handled once per pair that comes out (and BLOCK at either end of a range), however
    deep the tree is, and no block is hotter than the tree is deep.
    """
    ids = cut_lineage(paths.where("id is not null").select("id").distinct())
    ranks, ranges = prefix_ranges(ids, ids, [], "id", "id", strict=True, max_rows=max_rows or MAX_TREE_ROWS)
    last = F.col("first") + F.col("n_rows") - 1
    block = lambda rank: F.floor(rank / BLOCK)
    below = ranges.where("n_rows > 0").select(
        "id", "first", last.alias("last"), F.explode(F.sequence(block(F.col("first")), block(last))).alias("block")
    )
    rows = ranks.select(F.col("id").alias("descendant_id"), "rank", block(F.col("rank")).alias("block"))
    return below.join(rows, "block").where("rank between first and last").select("id", "descendant_id")


def subtree_rollup(tree: DataFrame, measures: Sequence[str] = (), max_rows: int | None = None) -> DataFrame:
    """(id, n_hidden, sum_<measure>..) of everything below each folder; a sum over nulls alone is null.

    Sorted by id, what is below a row is a range, so its sums are differences of running sums, and every row is
    one row however deep the tree is. Sums of integers and decimals are exact; those of floating-point numbers have the
    rounding of the running sum. The sum over the whole tree has to fit the type.
    """
    totals = [F.count(F.lit(1)).alias("n_hidden"), *[F.sum(m).alias(f"sum_{m}") for m in measures], *[F.count(m).alias(f"_n_{m}") for m in measures]]
    nodes = cut_lineage(tree.where("id is not null").groupBy("id").agg(*totals))
    _, ranges = prefix_ranges(nodes, nodes.select("id"), [], "id", "id", nodes.columns[1:], strict=True, max_rows=max_rows or MAX_TREE_ROWS)
    sums = [F.when(F.col(f"_n_{m}") > 0, F.col(f"sum_{m}")).alias(f"sum_{m}") for m in measures]
    return ranges.where("n_hidden > 0").select("id", "n_hidden", *sums)


def toggle_state(ids: DataFrame, clicks: DataFrame, initially_open: bool = False) -> DataFrame:
    """(id, is_open): every click on an id flips it."""
    odd = clicks.groupBy("id").agg((F.count(F.lit(1)) % 2 == 1).alias("_odd"))
    flipped = F.coalesce("_odd", F.lit(False))
    return ids.select("id").join(odd, "id", "left").select(
        "id", (~flipped if initially_open else flipped).alias("is_open")
    )


def toggle_all_state(
    ids: DataFrame, clicks: DataFrame, resets: DataFrame, keys: Sequence[str] = (), initially_open: bool = True
) -> DataFrame:
    """(keys, id, is_open): a "toggle all" sets every block, clicks after the last one flip single blocks.

    clicks is (keys, id, ts, seq), resets is (keys, ts, seq); seq orders events of the same instant.
    The keys name what a "toggle all" reaches, such as a page. Without keys it reaches everything, and
    its last instant is one row, which becomes a filter that the scan of the clicks gets.
    """
    keys = list(keys)
    last = resets.groupBy(*keys).agg(
        F.max(F.struct("ts", "seq")).alias("_last"), (F.count(F.lit(1)) % 2 == 1).alias("_flipped")
    )
    if keys:
        last = cut_lineage(last)
        later = clicks.join(last, keys, "left").where(F.col("_last").isNull() | (F.struct("ts", "seq") > F.col("_last")))
        blocks = ids.select(*keys, "id").join(last, keys, "left")
    else:
        end = last.select(F.col("_last.ts").cast("string").alias("ts"), F.col("_last.seq").alias("seq"), "_flipped").first()
        later, blocks = clicks, ids.select("id").withColumn("_flipped", F.lit(end["_flipped"]))
        if end["seq"] is not None:
            ts = F.lit(end["ts"]).cast(clicks.schema["ts"].dataType)
            later = clicks.where((F.col("ts") > ts) | ((F.col("ts") == ts) & (F.col("seq") > end["seq"])))
    odd = later.groupBy(*keys, "id").agg((F.count(F.lit(1)) % 2 == 1).alias("_odd"))
    flips = F.coalesce("_flipped", F.lit(False)) != F.coalesce("_odd", F.lit(False))
    return blocks.join(odd, [*keys, "id"], "left").select(*keys, "id", (F.lit(initially_open) != flips).alias("is_open"))
