"""Substring deduplication: Rabin-Karp hashes of token windows, counted in Spark, repeats merged into spans.

Every window of 50 words is covered, but only those that can repeat are shuffled. In each window the
smallest Rabin-Karp hash of its 26-word runs is its anchor; equal windows have equal anchors, and
neighbouring windows mostly share one, so a text of n words has about n / 13 runs of windows with one
anchor. The runs are counted first:

- an anchor that one document alone has is dropped with all its windows;
- runs with equal anchor and equal words form a class; in all documents but the first of a class, every
  window of the run also starts in that first document, so the whole run goes;
- only where an anchor has several classes do the windows of each class's first document have to be
  compared one by one, by two independent 64-bit hashes.

So a passage in a third of all documents costs one short row per document and run, aggregated by
partial minima and joined from tables, where AQE splits hot keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ..plans import broadcast_if_small, cut_lineage
from . import words
from .columns import restore, set_aside

WINDOW = 50


def _gram(window: int) -> int:
    return window // 2 + 1


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of `width` values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out, have = np.minimum(out[: len(out) - step], out[step:]), have + step
    return out


def _span_sums(tokens: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Rabin-Karp hash of any token spans [s, e)."""
    sums = words._prefix(tokens)
    inverse = words.powers(words.INVERSE, len(tokens) + 1)
    return lambda s, e: words.mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))


def _runs_of(block: words.Block, window: int) -> tuple[np.ndarray, ...]:
    """(text, anchor, content, first window, windows) of each run of windows with one anchor."""
    gram, tokens, owner = _gram(window), block.hashes(), block.owner
    if len(tokens) < window:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    anchor = _sliding_min(words.window_hashes(tokens, gram), window - gram + 1)
    inside = owner[: len(anchor)] == owner[window - 1 :]
    edge = np.flatnonzero((anchor[1:] != anchor[:-1]) | (owner[1 : len(anchor)] != owner[: len(anchor) - 1]) | (inside[1:] != inside[:-1]))
    start = np.concatenate([[0], edge + 1])
    end = np.concatenate([edge + 1, [len(anchor)]])
    start, end = start[inside[start]], end[inside[start]]
    content = _span_sums(tokens)(start, end + window - 1)
    text = owner[start]
    return text, anchor[start].view(np.int64), content.view(np.int64), start - block.first[text], end - start


def _runs(window: int, narrow: bool) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key"))
            for a, b, texts in words.pieces(batch.column("text")):
                text, anchor, content, start, count = _runs_of(words.block(texts), window)
                if narrow:  # one row per anchor and text
                    pairs = np.unique(np.stack([anchor, ids[a:b][text]], 1), axis=0) if len(text) else np.zeros((0, 2), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["anchor", "id"])
                else:
                    cols = [anchor, content, ids[a:b][text], keys[a:b][text], start, count]
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], ["anchor", "content", "id", "key", "start", "n"])

    return task


def _windows(window: int) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("id").to_pylist(), batch.column("key").to_pylist(), batch.column("text"), batch.column("spans"))
            for id_, key, text, spans in rows:
                block = words.block([text.as_py()])
                runs = spans.values
                s, n = (runs.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                at = np.unique(np.repeat(s - np.cumsum(n) + n, n) + np.arange(n.sum()))
                out = [_span_sums(block.hashes(seed))(at, at + window).view(np.int64) for seed in (0, 1)]
                same = [pa.array(np.full(len(at), v, np.int64)) for v in (id_, key)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, out), *same, pa.array(at)], ["h1", "h2", "id", "key", "start"])

    return task


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """(id, key, spans): for texts with windows that also start in a document with a smaller id, the runs
    (start, n) of such windows. key is xxhash64 of the text, so rows with one id and different texts stay apart."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).cast("binary").alias("text"))
    rows = rows.where("id IS NOT NULL AND text IS NOT NULL")
    seen = rows.mapInArrow(_runs(window, True), "anchor long, id long")
    shared = cut_lineage(seen.groupBy("anchor").agg(F.min("id").alias("_lo"), F.max("id").alias("_hi")).where("_lo < _hi").select("anchor"))
    every = rows.mapInArrow(_runs(window, False), "anchor long, content long, id long, key long, start long, n long")
    runs = cut_lineage(every.join(shared, "anchor"))
    classes = cut_lineage(runs.groupBy("anchor", "content").agg(F.min("id").alias("first")))
    several = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("anchor", F.lit(True).alias("mixed"))
    classes = cut_lineage(classes.join(cut_lineage(several), "anchor", "left"))
    placed = runs.join(classes, ["anchor", "content"])
    whole = placed.where("id > first").select("id", "key", "start", "n")
    leaders = placed.where("id = first AND mixed")
    spans = F.collect_list(F.struct("start", "n")).alias("spans")
    candidates = rows.join(broadcast_if_small(cut_lineage(leaders.groupBy("id", "key").agg(spans))), ["id", "key"])
    hashed = cut_lineage(candidates.dropDuplicates(["id", "key"]).mapInArrow(_windows(window), "h1 long, h2 long, id long, key long, start long"))
    firsts = cut_lineage(hashed.groupBy("h1", "h2").agg(F.min("id").alias("first")))
    single = hashed.join(firsts, ["h1", "h2"]).where("id > first").select("id", "key", "start", F.lit(1).cast("long").alias("n"))
    return cut_lineage(whole.union(single)).groupBy("id", "key").agg(spans)


_CUT = StructType([
    StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_sha256", StringType()),
    StructField("text", BinaryType()),
])


def cut(text: bytes | None, runs: tuple[np.ndarray, np.ndarray] | None, window: int = WINDOW) -> tuple[int, int, str, bytes | None]:
    """Words, words removed, digest of the kept words joined by one space, and the text without the removed words.

    White space that stood before a removed span stays, that after it goes; a text that loses nothing is unchanged.
    """
    if runs is None or not len(runs[0]):
        all_words = (text or b"").split()
        return len(all_words), 0, hashlib.sha256(b" ".join(all_words)).hexdigest(), text
    block = words.block([text])
    n = len(block.starts)
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[0], 1)
    np.add.at(depth, runs[0] + runs[1] + window - 1, -1)
    gone = np.concatenate([[False], np.cumsum(depth[:n]) > 0, [False]])
    edges = np.flatnonzero(gone[1:] != gone[:-1])
    keep, at = [], 0
    for i, j in zip(edges[0::2].tolist(), edges[1::2].tolist()):  # maximal removal intervals, in words
        keep.append(text[at : block.starts[i]])
        at = block.starts[j] if j < n else len(text)
    keep.append(text[at:])
    left = b"".join(keep)
    return n, int(gone.sum()), hashlib.sha256(b" ".join(left.split())).hexdigest(), left


def _cutter(window: int) -> Callable:
    """cut() over a batch; a text that loses nothing is not sent back (its text is null)."""

    @F.arrow_udf(_CUT)
    def task(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(texts, spans):
            runs = None if not s.is_valid else tuple(s.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            n_words, n_removed, digest, left = cut(t.as_py(), runs, window)
            out.append((n_words, n_removed, digest, left if n_removed else None))
        cols = list(zip(*out)) or [(), (), (), ()]
        types = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["n_words", "n_removed", "kept_sha256", "text"])

    return task


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with the text cut, plus n_words, n_removed and kept_sha256 (columns of these names are replaced).

    A word goes if a window of `window` words that covers it also starts in a document with a smaller id,
    judged on the input. Repeats inside one document stay. Null and shorter texts lose nothing and a null
    text stays null (the digest is that of no words); rows with a null id lose nothing and cost no other
    row anything; rows with one id count as one document; an empty table gives an empty one.
    """
    rows = _with_cuts(docs, id_col, text_col, window)
    cut = {c: F.col("cut").getField(c) for c in ("n_words", "n_removed", "kept_sha256")}
    return restore(rows, docs.columns, **{text_col: _left(text_col)}, **cut)


def cut_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, chars_col: str = "n_chars") -> DataFrame:
    """docs with the text cut as in remove_repeats and chars_col counted anew where words went; all other columns stay."""
    rows = _with_cuts(docs, id_col, text_col, window, whole=False)
    text = _left(text_col)
    n_chars = F.when(F.col("cut.n_removed") > 0, F.char_length(text).cast("long")).otherwise(F.col("row").getField(chars_col))
    return restore(rows, docs.columns, **{text_col: text, chars_col: n_chars})


def _left(text_col: str) -> Column:
    """The text without the removed words: as it was where none went."""
    return F.when(F.col("cut.n_removed") > 0, F.col("cut.text").cast("string")).otherwise(F.col("row").getField(text_col).cast("string"))


def _with_cuts(docs: DataFrame, id_col: str, text_col: str, window: int, whole: bool = True) -> DataFrame:
    """(row, cut): every row of docs and what is left of its text. Unless `whole`, Python gets only the texts
    that lose words, and n_words and kept_sha256 of the others mean nothing."""
    spans = repeated_spans(docs, id_col, text_col, window).select(F.col("id").alias("span_id"), F.col("key").alias("span_key"), "spans")
    rows = set_aside(docs, id=F.col(id_col).cast("long"), key=F.xxhash64(text_col))
    rows = rows.join(broadcast_if_small(cut_lineage(spans)), (F.col("id") == F.col("span_id")) & (F.col("key") == F.col("span_key")), "left")
    text = F.col("row").getField(text_col).cast("binary")
    text = text if whole else F.when(F.col("spans").isNotNull(), text)
    return rows.select("row", _cutter(window)(text, "spans").alias("cut"))
