"""SimHash near-duplicates: segment popcounts as a grid embedding, range join on it, exact check.

A fingerprint is cut into segments; the vector of set bits per segment is its place in a grid. One
changed bit moves one coordinate by one, so the Manhattan distance of two places is a lower bound of
the Hamming distance of the fingerprints. Two fingerprints within 2 bits therefore have places at
most 2 apart, and then some grid cell is at most 1 from both. The range join registers each
fingerprint in its own cell and the cells one step away (33 at most) and keeps cells with company.

The exact check needs no pairs. Fingerprints within 2 bits have a common middle: a 64-bit value that
differs from either in one bit at most. A fingerprint's middles lie in the cells it is registered in,
so in cells with company each fingerprint lists its middles there; those that share one are within 2
bits of each other, all of them, and are at most 65. One star per middle links them. Work is linear
in distinct fingerprints, however many of them are close together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from ..plans import broadcast_if_small, cut_lineage
from . import near
from .columns import restore, set_aside
from .components import components

WORDS = 3
SEED = 42
SEGMENT_BITS = 4
SEGMENTS = 64 // SEGMENT_BITS
CHUNK = 1 << 15


def fingerprint(text: bytes | None) -> int:
    """64 bits, unsigned: each set in over half of the shingles' hashes; 0 for a text without words."""
    words = (text or b"").lower().split()  # of bytes: only A-Z changes, only ASCII white space separates
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(1, len(words) - WORDS + 1)
    ends = ends[-n:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for a in range(0, n, CHUNK):
        spans = zip(starts[a : min(n, a + CHUNK)].tolist(), ends[a : a + CHUNK].tolist())
        h = np.array([digest(joined[i:j], SEED) for i, j in spans], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


@F.arrow_udf(LongType())
def _fingerprints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        yield pa.array(np.array([fingerprint(t.as_py()) for t in batch], np.uint64).view(np.int64), pa.int64())


def simhash(text: str | Column) -> Column:
    """Fingerprint of a text as a signed long; null and texts without words give 0."""
    return _fingerprints((F.col(text) if isinstance(text, str) else text).cast("binary"))


def as_hex(fp: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def place(fp: Column) -> Column:
    """Grid place: the number of set bits per segment, 4 bits each."""
    ones = F.lit(0x1111111111111111)
    bits = [F.shiftrightunsigned(fp, i).bitwiseAND(ones) for i in range(SEGMENT_BITS)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def _cells(fps: DataFrame) -> DataFrame:
    """(fp, cell, segment, step): the own cell (segment -1) and those one step away, counts within 0 and SEGMENT_BITS."""
    own = F.struct(F.col("place").alias("cell"), F.lit(-1).alias("segment"), F.lit(0).alias("step"))
    moves = []
    for s in range(SEGMENTS):
        count = F.shiftrightunsigned("place", 4 * s).bitwiseAND(F.lit(15))
        unit = F.lit(1 << (4 * s))
        for sign, ok in ((1, count < SEGMENT_BITS), (-1, count > 0)):
            move = F.struct((F.col("place") + sign * unit).alias("cell"), F.lit(s).alias("segment"), F.lit(sign).alias("step"))
            moves.append(F.when(ok, move))
    return fps.withColumn("_c", F.explode(F.filter(F.array(own, *moves), lambda c: c.isNotNull()))).select("fp", "_c.*")


def link_stars(fps: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components are those of all pairs within 2 bits."""
    fps = cut_lineage(fps.select("fp", place(F.col("fp")).alias("place")))
    cells = _cells(fps)
    company = cut_lineage(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("cell"))
    near = cells.join(company, "cell")
    bit = "shiftleft(1L, segment * {0} + i)".format(SEGMENT_BITS)
    middles = F.expr(
        "CASE WHEN segment < 0 THEN array(fp) ELSE transform(filter(sequence(0, {0}), i -> "
        "((fp & {1}) = 0) = (step > 0)), i -> fp ^ {1}) END".format(SEGMENT_BITS - 1, bit)
    )
    stars = near.select("fp", F.explode(middles).alias("middle")).groupBy("middle").agg(F.collect_set("fp").alias("_fps"))
    return (
        stars.where(F.size("_fps") > 1)
        .select(F.array_min("_fps").alias("a"), F.explode("_fps").alias("b"))
        .where("a != b").distinct()
    )


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id): near-duplicate groups of whole texts; one row per input row.

    fingerprint is 16 hex digits. component_id is the smallest id in the group of texts that links of 2 or
    fewer differing bits connect. Null and empty texts have fingerprint zero and link like any other; a
    null id never names a group (a group of null ids only has a null one); repeated rows each give a row;
    an empty table gives an empty one. Other columns are not read, whatever their names.
    """
    rows = cut_lineage(docs.select(F.col(id_col).alias("id"), simhash(text_col).alias("fp")))
    named = _named(rows)
    return rows.join(named, "fp").select(F.col("id").alias(id_col), as_hex("fp").alias("fingerprint"), F.col("name").alias("component_id"))


def _named(rows: DataFrame) -> DataFrame:
    """(fp, id) rows to (fp, name): name is the smallest id over all rows of the fingerprint's group."""
    classes = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("id")))
    roots = cut_lineage(components(link_stars(classes)))
    placed = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = cut_lineage(placed)
    names = cut_lineage(placed.groupBy("root").agg(F.min("id").alias("name")))
    return cut_lineage(placed.join(names, "root").select("fp", "name"))


def close_stars(classes: DataFrame) -> DataFrame:
    """Edges (a, b) from each class to the smallest one of its group of fingerprints that links of 2 or fewer differing bits connect.

    classes: (class, fp), each class once.
    """
    placed = cut_lineage(classes.select("class", "fp"))
    roots = cut_lineage(components(link_stars(placed.select("fp").distinct())))
    placed = placed.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("class", F.coalesce("root", "fp").alias("root"))
    placed = cut_lineage(placed)
    firsts = cut_lineage(placed.groupBy("root").agg(F.min("class").alias("b"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("root", "b"))
    return placed.join(firsts, "root").where("class != b").select(F.col("class").alias("a"), "b")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS, similarity: float | None = None) -> DataFrame:
    """The rows of docs without near-duplicates: of each group the row with the smallest id (null last, then
    the smallest hash of the text); of exact copies of that row one. All columns stay as they are.

    Links are 2 or fewer differing bits of the fingerprints; with a similarity they are pairs of texts whose sets of
    `width`-word shingles have at least this Jaccard similarity, compared exactly among candidates: fingerprints of these shingles
    within 2 bits, and MinHash cells for the pairs that lie further apart in bits (see `near`).
    """
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key")).alias("id")
    if similarity is None:
        if width != WORDS:
            raise ValueError(f"fingerprints are of {WORDS} words; another width needs a similarity")
        rows = cut_lineage(docs.select(key, simhash(text_col).alias("class")))
        names = _named(rows.select(F.col("class").alias("fp"), "id")).withColumnRenamed("fp", "class")
    else:
        rows = cut_lineage(docs.select(key, near._signed(width)(F.col(text_col).cast("binary")).alias("_s")).select("id", "_s.*"))
        names = _alike(rows, docs, id_col, text_col, width, similarity)
    gone = rows.select("class", "id").join(names, "class").where("id != name").select("id").distinct()
    gone = cut_lineage(gone.select(F.col("id.id").alias("gone_id"), F.col("id.key").alias("gone_key")))
    kept = set_aside(docs, id=F.col(id_col), key=F.xxhash64(text_col))
    kept = kept.join(broadcast_if_small(gone), F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("gone_key")), "left_anti")
    if not rows.groupBy("id").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["id", "key"])
    return restore(kept, docs.columns)


def _alike(rows: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, similarity: float) -> DataFrame:
    """(id, class, n, fp, cells) rows to (class, name) for texts in company: the smallest id of the group of texts that links connect.

    Candidates are texts with fingerprints that links of 2 bits connect, and those that share a cell; only they are read for the comparison.
    """
    same = [F.first(c).alias(c) for c in ("n", "fp", "cells")]
    classes = cut_lineage(rows.groupBy("class").agg(F.min("id").alias("id"), *same, F.count(F.lit(1)).alias("copies")))
    members = near.members(classes.select("class", "n", "cells"), stars=close_stars(classes.where("n > 0")))
    one = members.join(classes.select("class", F.struct(F.col("id.id").alias("id")).alias("who"), F.col("id.key").alias("key")), "class")
    # Structs are equal where both ids are null, and rows come grouped as they were joined: the text moves once, or not at all.
    who = [F.struct(F.col(id_col).alias("id")).alias("who"), F.xxhash64(text_col).alias("key")]
    texts = docs.select(*who, F.col(text_col).cast("binary").alias("text")).join(broadcast_if_small(cut_lineage(one)), ["who", "key"])
    texts = texts.groupBy("who", "key", "class", "root", "blocks").agg(F.first("text").alias("text"))
    roots = components(near.links(texts.select("class", "root", "blocks", "text"), width, similarity))
    placed = classes.select("class", "id", "copies").join(roots.withColumnRenamed("node", "class"), "class", "left").where("copies > 1 OR root IS NOT NULL")
    placed = cut_lineage(placed.withColumn("root", F.coalesce("root", "class")))
    names = cut_lineage(placed.groupBy("root").agg(F.min("id").alias("name")))
    return cut_lineage(placed.join(names, "root").select("class", "name"))
