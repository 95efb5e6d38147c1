"""Merkle manifest of a table: a tree of 16-way hashes per source, and a tree over the sources' roots.

Leaves are numbered per tree and every 4096 of them (three levels) are a superblock. Going up, each table
of nodes is reduced to one node per superblock until every tree has one. Going down, nodes are cogrouped by
superblock with the nodes outside it that proofs of this superblock need, which is one short row; the
task rebuilds the levels inside, appends the outer nodes, and hands each node its whole path. For leaves it
digests the path and folds it with the leaf as it is claimed to be. A superblock never holds more than 4096
nodes, so a source with a third of all rows is many superblocks like any other, and texts are never shuffled:
only digests of 32 bytes are.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from ..plans import cut_lineage, numbered

FANOUT = 16
LEVELS = 3  # in a superblock
#: The tree over the roots of all sources.
TOP = "top"


def encoded(col: Column) -> Column:
    """The value with its length before it (bytes of UTF-8), or `-` for null."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest_of(*cols: Column) -> Column:
    """SHA-256 over the encoded values of a row, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[encoded(c) for c in cols]).cast("binary"), 256))


def parent(nodes: list[bytes]) -> bytes:
    return sha256("".join([n.hex() for n in nodes]).encode()).digest()


def levels_of(nodes: list[bytes], first: bool, depth: int) -> list[list[bytes]]:
    """All levels of a superblock from its nodes up to one node. The first of a tree ends as soon as one node
    remains: it is full, or the only one. Any other has all `depth` levels, as the full ones before it have."""
    levels = [nodes]
    while len(levels) <= depth and (not first or len(levels[-1]) > 1):
        levels.append([parent(levels[-1][i : i + FANOUT]) for i in range(0, len(levels[-1]), FANOUT)])
    return levels


def siblings_inside(levels: list[list[bytes]], at: int) -> list[tuple[int, list[bytes]]]:
    """Per level below the last: the place in the run, and the other nodes of the run."""
    path = []
    for level in levels[:-1]:
        lo = at - at % FANOUT
        path.append((at - lo, level[lo:at] + level[at + 1 : lo + FANOUT]))
        at //= FANOUT
    return path


def fold(node: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a node and the siblings on its path give."""
    for place, others in path:
        node = parent([*others[:place], node, *others[place:]])
    return node


def proof(path: list[tuple[int, list[bytes]]]) -> bytes:
    return parent([n for _, others in path for n in others])


_PATH = "array<struct<place:int,others:array<binary>>>"
_NODE = "tree string, pos long, node binary"
_OUTER = f"tree string, pos long, path {_PATH}, subroot binary, root binary"
_VERIFIED = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


class Superblocks:
    """What tasks do with the nodes of one superblock of `depth` levels, and the tables over all superblocks.

    Spark counts the arguments of a function to see whether it wants the key, hence plain functions around the methods.
    """

    def __init__(self, depth: int) -> None:
        self.depth = depth

    def keyed(self, nodes: DataFrame) -> DataFrame:
        return nodes.withColumn("block", F.floor(F.col("pos") / FANOUT**self.depth))

    def climb(self, nodes: DataFrame) -> list[DataFrame]:
        """Tables (tree, pos, node), from the given one up to that with one node per tree, each with a row per superblock of the one before."""
        tables = [nodes]
        while tables[-1].where("pos > 0").limit(1).count():
            tables.append(cut_lineage(self.keyed(tables[-1]).groupBy("tree", "block").applyInPandas(lambda rows: self._reduce(rows), _NODE)))
        return tables

    def descend(self, nodes: DataFrame, outer: DataFrame) -> DataFrame:
        """(tree, pos, path, subroot, root) of each node, from those of the superblocks."""
        return self._exchange(nodes, outer).applyInPandas(lambda key, rows, above: self._paths(key, rows, above), _OUTER)

    def verify(self, leaves: DataFrame, outer: DataFrame) -> DataFrame:
        return self._exchange(leaves, outer).applyInPandas(lambda key, rows, above: self._verify(key, rows, above), _VERIFIED)

    def _exchange(self, nodes: DataFrame, outer: DataFrame) -> PandasCogroupedOps:
        return self.keyed(nodes).groupBy("tree", "block").cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block"))

    def _reduce(self, nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        block = int(nodes["block"].iloc[0])
        top = levels_of(list(nodes["node"]), block == 0, self.depth)[-1][0]
        return pd.DataFrame({"tree": [nodes["tree"].iloc[0]], "pos": [block], "node": [top]})

    def _whole_paths(self, block: int, nodes: pd.DataFrame, outer: pd.DataFrame) -> Iterator[list[tuple[int, list[bytes]]]]:
        """Per node: the siblings inside the superblock, then the outer nodes."""
        levels = levels_of(list(nodes["node"]), block == 0, self.depth)
        rest = [(step["place"], list(step["others"])) for step in outer["path"].iloc[0]]
        return (siblings_inside(levels, i) + rest for i in range(len(nodes)))

    def _paths(self, key: tuple, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        paths = [[{"place": p, "others": o} for p, o in path] for path in self._whole_paths(key[1], nodes, outer)]
        return pd.DataFrame({
            "tree": nodes["tree"], "pos": nodes["pos"], "path": paths, "subroot": outer["subroot"].iloc[0], "root": outer["root"].iloc[0],
        })

    def _verify(self, key: tuple, leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        """Leaves with the digest of their path and the root that it gives with the row as claimed."""
        leaves = leaves.sort_values("pos")
        subroot, root, rows = outer["subroot"].iloc[0], outer["root"].iloc[0], []
        for path, leaf, claimed in zip(self._whole_paths(key[1], leaves, outer), leaves["node"], leaves["claimed"]):
            rows.append([b.hex() for b in (leaf, subroot, root, proof(path), fold(leaf if claimed is None else claimed, path))])
        done = pd.DataFrame(rows, columns=["leaf", "subroot", "root", "proof_sha256", "folded_root"])
        return done.assign(id=leaves["id"].to_numpy(), verified=done["folded_root"] == done["root"])


def tree_name(source: Column) -> Column:
    """A source as the name of its tree, never null: null sorts before all others, those by their bytes."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def manifest(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", cols: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    claimed: dict[str, Column] | None = None, where: Column | None = None, levels: int = LEVELS,
) -> DataFrame:
    """(id_col, leaf, subroot, root, proof_sha256, folded_root, verified) of every row: its place in the Merkle manifest.

    A leaf is the SHA-256 of the values of cols, each with its length. Leaves of a source are ordered by id;
    runs of 16 become their hash until one node, the subroot, remains, and the subroots, by source, become the
    root likewise. A proof is the hash of all siblings on the way up. folded_root is the root recomputed from
    the siblings and from the row as it is claimed to be: `claimed` replaces columns, on rows `where` holds.

    Nulls in any column are values of their own. Rows with null ids come first; rows with one id are ordered
    by their leaf, and equal rows are equal leaves side by side. A lone row is its own subroot. Columns not in
    cols are not read, so their names do not matter; an empty table gives an empty one. `levels` of the tree are a superblock.
    """
    changed = [claimed.get(c, F.col(c)) if claimed else F.col(c) for c in cols]
    leaf, other = digest_of(*[F.col(c) for c in cols]), F.lit(None).cast("binary")
    if claimed:
        other = F.when(where if where is not None else F.lit(True), digest_of(*changed))
    rows = docs.select(F.col(id_col).alias("id"), tree_name(F.col(source_col)).alias("tree"), leaf.alias("node"), other.alias("claimed"))
    leaves = cut_lineage(numbered(cut_lineage(rows), ["tree"], ["id", "node"], "pos"))
    blocks = Superblocks(levels)
    tables = blocks.climb(leaves.select("tree", "pos", "node"))
    subroots = tables[-1].select(F.col("tree").alias("name"), F.lit(TOP).alias("tree"), F.col("node"))
    subroots = cut_lineage(numbered(subroots, ["tree"], ["name"], "pos"))
    tops = blocks.climb(subroots.select("tree", "pos", "node"))
    empty = F.array().cast(_PATH)
    outer = tops[-1].select("tree", "pos", empty.alias("path"), F.col("node").alias("subroot"), F.col("node").alias("root"))
    for nodes in reversed(tops[:-1]):
        outer = cut_lineage(blocks.descend(nodes, outer))
    outer = outer.select("pos", "path", "root").join(subroots.select("pos", "name", F.col("node").alias("subroot")), "pos")
    outer = cut_lineage(outer.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", "subroot", "root"))
    for nodes in reversed(tables[1:-1]):
        outer = cut_lineage(blocks.descend(nodes, outer))
    done = blocks.verify(leaves.withColumn("id", F.col("id").cast("string")), outer)  # pandas would turn numbers beside nulls into floats
    return done.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), *done.columns[1:])
