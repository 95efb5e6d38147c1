"""Embedding near-duplicates by lattice hashing: random projections decoded to E8 points, cosine verified.

Each of TABLES tables projects a unit vector to BLOCKS * 8 random orthogonal directions and decodes each 8 of
them to the nearest point of the lattice E8. The points together are a cell. A vector is registered in
its own cell and in the PROBES cells that a step to a neighbouring lattice point (one of 240 minimal
vectors) reaches at the least extra distance. Vectors that share a cell are compared exactly.

Equal vectors are one class with a weight, so copies are never compared. Only cells with company are
gone through, in squares of at most about BLOCK by BLOCK classes: a cell with more is cut by a hash of the
class, so no task gets a whole hot cell. Tasks return one row per class, with its links (a pair counts
in the smallest cell that both share) and one edge of a spanning forest; pairs are not written.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..plans import cut_lineage
from .components import components
from .words import mix

TABLES = 14
BLOCKS = 3
PROBES = 5
SCALE = 0.8  # lattice units per typical projected length of 1; for a cosine of 0.9
COSINE = 0.9
BLOCK = 512
WIDTH = 8 * BLOCKS
_SEED = 20240229


@lru_cache
def roots() -> np.ndarray:
    """The 240 minimal vectors of E8, as columns: all (+-1, +-1, 0..) and all (+-1/2)^8 with an even number of minus signs."""
    whole = []
    for (i, j), (a, b) in itertools.product(itertools.combinations(range(8), 2), itertools.product((1, -1), repeat=2)):
        v = np.zeros(8)
        v[i], v[j] = a, b
        whole.append(v)
    half = [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array([*whole, *half]).T


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and where the sum is odd move the worst coordinate the other way."""
    z = np.rint(x)
    odd = np.flatnonzero(z.sum(1) % 2)
    worst = np.abs(x - z)[odd].argmax(1)
    z[odd, worst] += np.where(x[odd, worst] >= z[odd, worst], 1.0, -1.0)
    return z


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, the union of D8 and D8 shifted by one half."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


@lru_cache(maxsize=8)
def _tables(dim: int, scale: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per table: a projection (columns orthonormal as far as the dimension allows) and odd factors that hash a cell."""
    rng, size = np.random.default_rng(_SEED), max(dim, WIDTH)
    out = []
    for _ in range(TABLES):
        turn = np.linalg.qr(rng.normal(size=(size, size)))[0][:dim, :WIDTH]
        out.append((turn * np.sqrt(size / 8) / scale, rng.integers(1 << 20, 1 << 62, WIDTH + 1) * 2 + 1))
    return out


def cells(vectors: np.ndarray, scale: float = SCALE) -> np.ndarray:
    """Registered cells, as hashes, of unit vectors of one dimension: TABLES * (1 + PROBES) per row, ascending."""
    n, dim = vectors.shape
    found = []
    for table, (turn, odd) in enumerate(_tables(dim, scale)):
        y = vectors @ turn
        points = np.concatenate([nearest_e8(y[:, 8 * b : 8 * b + 8]) for b in range(BLOCKS)], 1)
        gain = np.concatenate([(y - points)[:, 8 * b : 8 * b + 8] @ roots() for b in range(BLOCKS)], 1)
        steps = np.argpartition(-gain, PROBES, axis=1)[:, :PROBES]
        own = np.rint(points * 2).astype(np.int64) @ odd[:WIDTH] + odd[WIDTH:] * (dim + 1) + table
        found.append(own)
        for p in range(PROBES):
            block, root = steps[:, p] // 240, steps[:, p] % 240
            move = np.rint(roots().T[root] * 2).astype(np.int64)
            factors = odd[:WIDTH].reshape(BLOCKS, 8)[block]
            found.append(own + (move * factors).sum(1))
    return np.sort(mix(np.stack(found, 1).view(np.uint64)).view(np.int64), axis=1)


def unit(vector: list | None) -> np.ndarray | None:
    """The vector in double precision with length 1; None if it is null, empty, zero or not finite."""
    if not vector or any(x is None for x in vector):
        return None
    v = np.asarray(vector, np.float64)
    top = np.abs(v).max()
    if not np.isfinite(top) or top == 0:
        return None
    v = v / top
    return v / np.sqrt(v @ v)


def _registered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept: dict[int, list[tuple[int, np.ndarray]]] = {}
        for i, v in enumerate(batch.column("vec").to_pylist()):
            u = unit(v)
            if u is not None:
                kept.setdefault(len(u), []).append((i, u))
        for rows in kept.values():
            for a in range(0, len(rows), 1024):
                at = pa.array([i for i, _ in rows[a : a + 1024]])
                units = np.stack([u for _, u in rows[a : a + 1024]])
                part, found = batch.take(at), cells(units)
                vecs = [u.tobytes() for u in units]
                cols = [part.column("class"), part.column("weight"), pa.array(vecs, pa.binary()), pa.array(list(found), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, ["class", "weight", "unit", "cells"])


def _forest(linked: np.ndarray) -> np.ndarray:
    """Smallest index that links reach, for a symmetric matrix with a true diagonal."""
    n = len(linked)
    label = np.arange(n)
    while True:
        new = np.where(linked, label[None, :], n).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _shared_before(a: np.ndarray, b: np.ndarray, cell: int) -> np.ndarray:
    """Whether each pair of rows of a and b shares a value below `cell`."""
    values, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    at = at.reshape(len(a) + len(b), -1)
    below = int(np.searchsorted(values, cell))
    has = np.zeros((len(a) + len(b), len(values)), np.float32)
    np.put_along_axis(has, at, 1, 1)
    has = has[:, :below]
    has = has[:, has.sum(0) > 1]
    return has[: len(a)] @ has[len(a) :].T > 0


def square(cell: int, i: int, j: int, block: np.ndarray, cls: np.ndarray, weight: np.ndarray, units: np.ndarray, regs: np.ndarray, cosine: float):
    """(class, links, root) of the rows of one square of a cell: blocks i and j of it against each other."""
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    near = units[left] @ units[right].T >= cosine
    if i == j:
        np.fill_diagonal(near, False)
    if not near.any():
        return None
    first = near & ~_shared_before(regs[left], regs[right], cell)
    links = np.zeros(len(cls), np.int64)
    links[left] += first @ weight[right]
    if i != j:
        links[right] += first.T @ weight[left]
    linked = np.eye(len(cls), dtype=bool)
    linked[np.ix_(left, right)] |= near
    linked[np.ix_(right, left)] |= near.T
    order = np.argsort(cls, kind="stable")
    root = np.empty(len(cls), np.int64)
    root[order] = cls[order][_forest(linked[np.ix_(order, order)])]
    has = linked.sum(1) > 1
    return cls[has], links[has], root[has]


def _compare(cosine: float) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []

        def flush() -> None:
            if len(rows) < 2:
                return
            block, cls, weight, units, regs = zip(*rows)
            if len({len(u) for u in units}) > 1:  # equal hashes of cells of different dimensions
                return
            units = np.stack([np.frombuffer(u) for u in units])
            found = square(*key, np.array(block), np.array(cls), np.array(weight), units, np.array(regs), cosine)
            if found:
                out.append(found)

        def batch_of() -> pa.RecordBatch:
            cols = [np.concatenate(c) for c in zip(*out)]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["class", "links", "root"])

        for batch in batches:
            c = {n: batch.column(n).to_pylist() for n in ("cell", "i", "j", "block", "class", "weight", "unit")}
            regs = batch.column("cells")
            width = len(regs.values) // max(1, len(regs)) if len(regs) else 0
            flat = regs.flatten().to_numpy().reshape(len(regs), width)
            for r, at in enumerate(zip(c["cell"], c["i"], c["j"])):
                if at != key:
                    flush()
                    key, rows = at, []
                rows.append((c["block"][r], c["class"][r], c["weight"][r], c["unit"][r], flat[r]))
            if out:
                yield batch_of()
        flush()
        if out:
            yield batch_of()

    return task


def near_links(classes: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(class, links, root) parts for distinct vectors (class, weight, vec): links to be summed per class, roots to be joined up."""
    wide = cut_lineage(classes.mapInArrow(_registered, "class long, weight long, unit binary, cells array<long>"))
    at = wide.select("class", F.explode(F.array_distinct("cells")).alias("cell"))
    company = cut_lineage(at.groupBy("cell").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    near = at.join(company, "cell").withColumn("_blocks", F.ceil(F.col("_n") / block).cast("int"))
    near = near.withColumn("block", F.pmod(F.xxhash64("class", F.lit(7)), F.col("_blocks")).cast("int"))
    near = near.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    near = near.select("class", "cell", "block", F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j"))
    rows = cut_lineage(near).join(wide, "class")
    keys = ["cell", "i", "j"]
    parts = rows.repartition(*keys).sortWithinPartitions(*keys)
    return parts.select(*keys, "block", "class", "weight", "unit", "cells").mapInArrow(_compare(cosine), "class long, links long, root long")


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(id, n_links, component_id, kept): one row per input row.

    n_links: other rows at `cosine` or more that the tables find; component_id: smallest id that links
    reach; kept: the id is that one. Equal vectors link with each other. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, nor do vectors of different lengths. A null id never names a group; a group of
    null ids only has a null one and its rows are kept. Repeated rows each give a row; an empty table gives
    an empty one. Other columns are not read, whatever their names.
    """
    vec = F.col(vec_col).cast("array<double>")
    bad = vec.isNull() | F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists(vec, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"), F.coalesce(~bad, F.lit(False)).alias("ok"))
    rows = rows.withColumn("class", F.when(F.col("ok"), F.xxhash64("vec")))
    classes = cut_lineage(
        rows.where("ok").groupBy("class", "vec").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("weight"))
    )
    found = cut_lineage(near_links(classes.select("class", "weight", "vec"), cosine))
    links = cut_lineage(found.groupBy("class").agg(F.sum("links").alias("links")))
    roots = cut_lineage(components(found.select(F.col("class").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "class"))
    placed = classes.select("class", "first", "weight").join(links, "class", "left").join(roots, "class", "left")
    placed = cut_lineage(placed.withColumn("root", F.coalesce("root", "class")))
    names = cut_lineage(placed.groupBy("root").agg(F.min("first").alias("component_id")))
    named = placed.join(names, "root").select("class", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = rows.select("id", "ok", "class").join(cut_lineage(named), "class", "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )
