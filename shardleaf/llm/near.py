"""Near-duplicates by verified Jaccard similarity of word shingles; candidates from SimHash and several MinHash fingerprints.

A text is the set of its runs of `width` words, lower-cased; a shorter text is one shingle, and texts without
words equal each other only. BANDS fingerprints of ROWS minima each name BANDS cells of a text: two texts
share one with a chance of 1 - (1 - s^ROWS)^BANDS at similarity s (0.9999 at 0.8). Texts of equal words are
one class. Classes whose SimHash differs in 2 bits at most (see `simhash`) or that shared cells connect are a candidate group, and
all pairs of a group are compared by their whole sets, so a pair is missed only if no chain of these leads from one to the other.

Groups are found from the cells alone, and only texts in company are read again. A large group is cut by a hash
of the class into blocks, and squares of two blocks are compared, so no task gets a whole hot group. All blocks meet the
first one, and then those classes that this leaves outside the group's largest component meet all others. So
a group of n copies of one text takes 2 n sets, and a group in which k classes stay apart k * n comparisons.
Squares return the edges of a spanning forest; pairs are not written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ..plans import cut_lineage
from . import words
from .components import components
from .lattice import _forest
from .substrings import _span_sums

BANDS = 30
ROWS = 6
BLOCK = 256  # classes in a block of a candidate group
BLOCK_SHINGLES = 1 << 21
COLUMNS = 1 << 12  # shingles compared at a time
_ODD = np.random.default_rng(20240301).integers(1 << 20, 1 << 62, BANDS * ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(block: words.Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): those of text i are hashes[first[i] : first[i + 1]], in order and with repeats."""
    n = np.where(block.counts > 0, np.maximum(1, block.counts - width + 1), 0)
    first = np.concatenate([[0], np.cumsum(n)])
    owner = np.repeat(np.arange(len(n)), n)
    start = block.first[owner] + np.arange(first[-1]) - first[owner]
    end = np.minimum(start + width, block.first[owner + 1])
    return _span_sums(block.hashes(0, words.LOWER))(start, end), first


def fingerprints(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SimHash of each text: a bit is set if it is in over half of the shingles' hashes; 0 without shingles."""
    n = np.diff(first)
    some, out = np.flatnonzero(n), np.zeros(len(n), np.uint64)
    for bit in np.arange(64 if len(some) else 0, dtype=np.uint64):
        ones = np.add.reduceat(h >> bit & np.uint64(1), first[some])
        out[some] |= (ones.astype(np.int64) * 2 > n[some]).astype(np.uint64) << bit
    return out


def signatures(texts: list[bytes | None], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, shingles, cells) of each text; cells are BANDS longs, of no meaning for a text without words."""
    return _signatures(texts, width)[:3]


def _signatures(texts: list[bytes | None], width: int) -> tuple[np.ndarray, ...]:
    block = words.block(texts)
    h, first = shingles(block, width)
    same = _span_sums(block.hashes(1, words.LOWER))(block.first[:-1], block.first[1:])
    cells = np.zeros((len(texts), BANDS), np.uint64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        at = first[some]
        for band in range(BANDS):
            cell = np.full(len(some), band + 1, np.uint64)
            for odd in _ODD[band * ROWS : (band + 1) * ROWS]:
                cell = words.mix(cell + np.minimum.reduceat(h * odd, at))
            cells[some, band] = cell
    return same.view(np.int64), np.diff(first), cells.view(np.int64), fingerprints(h, first).view(np.int64)


def _signed(width: int) -> Callable:
    kind = StructType([StructField(c, LongType()) for c in ("class", "n", "fp")] + [StructField("cells", ArrayType(LongType()))])

    @F.arrow_udf(kind)
    def task(texts: pa.Array) -> pa.Array:
        parts = [_signatures(some, width) for _, _, some in words.pieces(texts)] or [_signatures([], width)]
        same, n, cells, prints = (np.concatenate(c) for c in zip(*parts))
        cells = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS), pa.array(cells.ravel()))
        return pa.StructArray.from_arrays([pa.array(same), pa.array(n.astype(np.int64)), pa.array(prints), cells], ["class", "n", "fp", "cells"])

    return task


def _sets(width: int) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in words.pieces(batch.column("text")):
                h, first = shingles(words.block(texts), width)
                sets = [np.unique(h[x:y]).tobytes() for x, y in zip(first[:-1], first[1:])]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("class", "root", "blocks")] + [pa.array(sets, pa.binary())], ["class", "root", "blocks", "shingles"])

    return task


def similar(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs of sets, each an array of distinct values, have at least this Jaccard similarity."""
    sets = [*left, *right]
    sizes = np.array([len(s) for s in sets])
    _, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1  # of the shingles that more than one set has
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = counts[at] > 1
    owner, column = owner[shared], number[at[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(left), len(right)))
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        x, y = np.searchsorted(column, (a, a + COLUMNS))
        has = np.zeros((len(sets), min(COLUMNS, int(column[-1]) + 1 - a)), np.float32)
        has[owner[x:y], column[x:y] - a] = 1
        both += has[: len(left)] @ has[len(left) :].T
    return both / (sizes[: len(left), None] + sizes[None, len(left) :] - both) >= similarity


def _compare(similarity: float) -> Callable:
    def edges(key: tuple, rows: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray] | None:
        _, i, j = key
        block, cls = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.int64)
        sets = [np.frombuffer(r[2], np.uint64) for r in rows]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if not len(left) or not len(right):
            return None
        near = similar([sets[x] for x in left], [sets[x] for x in right], similarity)
        linked = np.eye(len(rows), dtype=bool)
        linked[np.ix_(left, right)] |= near
        linked[np.ix_(right, left)] |= near.T
        root = cls[_forest(linked)]
        return cls[cls != root], root[cls != root]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []

        def flush() -> None:
            if len(rows) > 1 and (found := edges(key, rows)):
                out.append(found)

        def batch_of() -> pa.RecordBatch:
            a, b = (np.concatenate(c) for c in zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            c = {n: batch.column(n).to_pylist() for n in ("root", "i", "j", "block", "class")}
            sets = batch.column("shingles")  # copied out of the batch for one square at a time
            for r, at in enumerate(zip(c["root"], c["i"], c["j"])):
                if at != key:
                    flush()
                    key, rows = at, []
                rows.append((c["block"][r], c["class"][r], sets[r].as_py()))
            if out:
                yield batch_of()
        flush()
        if out:
            yield batch_of()

    return task


def members(rows: DataFrame, block: int = BLOCK, stars: DataFrame | None = None) -> DataFrame:
    """(class, root, blocks) of the classes that share a cell with another one or have an edge in stars: their candidate group
    and its number of blocks.

    rows: (class, n, cells), each class once; stars: (a, b), further pairs of classes to compare.
    """
    cells = rows.where("n > 0").select("class", F.explode("cells").alias("cell"))
    company = cut_lineage(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("_n"), F.min("class").alias("_first")).where("_n > 1").select("cell", "_first"))
    shared = cells.join(company, "cell").where("class != _first").select(F.col("class").alias("a"), F.col("_first").alias("b"))
    groups = cut_lineage(components(shared if stars is None else shared.union(stars.select("a", "b"))))
    groups = cut_lineage(groups.join(rows.select(F.col("class").alias("node"), "n"), "node"))
    many = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = cut_lineage(groups.groupBy("root").agg(many.alias("blocks")))
    return cut_lineage(groups.join(sizes, "root").select(F.col("node").alias("class"), "root", "blocks"))


def links(texts: DataFrame, width: int, similarity: float, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between classes that connect those of pairs with at least this similarity.

    texts: (class, root, blocks, text) of members, each class once. First all blocks of a group meet its
    block 0, which takes two copies of a set however large the group is, and connects nearly all of a dense
    group. Pairs that are still apart lie in two of the components that gives, so one of them at least is outside the
    largest one: those outside meet all others of the group, in squares of two blocks.
    """
    texts = texts.select("class", "root", "blocks", F.col("text").cast("binary").alias("text"))
    sets = cut_lineage(texts.mapInArrow(_sets(width), "class long, root long, blocks int, shingles binary"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    first = sets.withColumn("block", _block("blocks")).withColumn("i", F.lit(0))
    first = first.withColumn("j", F.explode(F.when(F.col("block") == 0, every).otherwise(F.array("block"))))
    edges = cut_lineage(_squares(first, similarity))
    large = sets.where("blocks > 1")
    if large.isEmpty():
        return edges

    parts = components(edges).select(F.col("node").alias("class"), F.col("root").alias("part"))
    placed = large.select("class", "root", (F.octet_length("shingles") / 8).alias("n")).join(parts, "class", "left")
    placed = cut_lineage(placed.withColumn("part", F.coalesce("part", "class")))
    sizes = cut_lineage(placed.groupBy("root", "part").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n")))
    main = F.max_by(F.struct("part", "size", "n"), F.struct("size", "part"))
    main = sizes.groupBy("root").agg(main.alias("main"), F.sum("size").alias("size"), F.sum("n").alias("n"))
    few = F.greatest(F.ceil((F.col("size") - F.col("main.size")) / block), F.ceil((F.col("n") - F.col("main.n")) / BLOCK_SHINGLES))
    main = cut_lineage(main.select("root", F.col("main.part").alias("main"), few.cast("int").alias("few")).where("few > 0"))
    meet = cut_lineage(placed.join(main, "root").select("class", "few", (F.col("part") != F.col("main")).alias("outside")))
    rest = large.join(meet, "class")
    rest = rest.withColumn("block", F.when(F.col("outside"), _block("few")).otherwise(F.col("few") + _block("blocks")))
    others = F.sequence(F.lit(0), F.when(F.col("outside"), F.col("few") + F.col("blocks")).otherwise(F.col("few")) - 1)
    rest = rest.withColumn("other", F.explode(others))
    rest = rest.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    return edges.union(cut_lineage(_squares(rest, similarity)))


def _block(blocks: str) -> Column:
    return F.pmod(F.xxhash64("class"), F.col(blocks)).cast("int")


def _squares(rows: DataFrame, similarity: float) -> DataFrame:
    rows = rows.select("root", "i", "j", "block", "class", "shingles").repartition("root", "i", "j")
    return rows.sortWithinPartitions("root", "i", "j").mapInArrow(_compare(similarity), "a long, b long")
