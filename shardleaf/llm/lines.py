"""Line deduplication: a sharded minimal perfect hash over all distinct lines, probed by documents.

- Lines become 128-bit hashes. A task packs the hashes of a block of texts into one row, each different
  line of the block once.
- Distinct hashes are dealt into shards of bounded size. A shard is a row of bytes: the bits of a minimal perfect
  hash, and by its numbers an array of fingerprints, one of document counts and one of smallest document ids.
- A block sends each shard one row of hashes; the shard streams through a task, its arrays first, and answers
  for the lines that several documents hold. A line in a third of all documents is one probe per block, so no
  line is joined with the documents that hold it.
- Each block turns its answers into line numbers to drop, and texts meet them once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ..plans import cut_lineage
from . import words

MIN_CHARS = 10
BLOCK_BYTES = 8 << 20  # text in a block
SHARD_LINES = 1 << 17  # distinct lines in a shard, about
SHARDS_PER_TASK = 16
SPACES = bytes([0x20, *range(0x09, 0x0E)])
ROOM = 2  # bits of a level per line that is still without a number
_STEP = np.uint64(0xD6E8FEB86659FD93)


# Lines

def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z in lower case."""
    return line.strip(SPACES).lower()


def long_enough(key: bytes, chars: int) -> bool:
    """At least `chars` code points: a byte that does not continue another one starts a code point."""
    return len(key) >= chars and (len(key) >= 4 * chars or sum(b & 0xC0 != 0x80 for b in key) >= chars)


def text_lines(text: bytes | None, chars: int) -> tuple[list[bytes], list[int]]:
    """128-bit hashes and numbers of the lines of a text that are long enough."""
    hashes, at = [], []
    for i, line in enumerate((text or b"").split(b"\n")):
        key = line_key(line)
        if long_enough(key, chars):
            hashes.append(xxhash.xxh3_128_digest(key))
            at.append(i)
    return hashes, at


_BLOCK = "block long, ids binary, texts binary, n_held binary, at binary, line binary, hashes binary, n_hashes long"


def _blocks(chars: int) -> Callable:
    """Blocks: different hashes of the block, and per text the numbers of its lines and which hash each has."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key"))
            for a, b in words.groups(texts, BLOCK_BYTES):
                numbers: dict[bytes, int] = {}
                n_held, at, line = [], [], []
                for t in texts[a:b]:
                    hashes, where = text_lines(t, chars)
                    n_held.append(len(where))
                    at += where
                    line += [numbers.setdefault(h, len(numbers)) for h in hashes]
                cols = [
                    pa.array([block]), *(pa.array([np.ascontiguousarray(c[a:b], np.int64).tobytes()], pa.binary()) for c in (ids, keys)),
                    *(pa.array([np.array(c, "<u4").tobytes()], pa.binary()) for c in (n_held, at, line)),
                    pa.array([b"".join(numbers)], pa.binary()), pa.array([len(numbers)]),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["block", "ids", "texts", "n_held", "at", "line", "hashes", "n_hashes"])
                block += 1

    return task


def _hash_pairs(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(packed, "<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return (h % np.uint64(shards)).astype(np.int64)


# The index

class PerfectHash:
    """A minimal perfect hash of distinct pairs of 64-bit hashes: levels of bits, where a set bit is a place that
    just one of the remaining keys took; a key's number is how many bits are set before its own."""

    def __init__(self, sizes: list[int], bits: bytes) -> None:
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.sizes = sizes
        self.packed = np.frombuffer(bits, np.uint8)
        ones = np.bitwise_count(self.packed).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    @staticmethod
    def place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
        return (words.mix(h1 ^ words.mix(h2 + np.array([level + 1], np.uint64) * _STEP)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        sizes, parts = [], []
        while len(h1):
            size = -(-ROOM * len(h1) // 8) * 8
            at = cls.place(h1, h2, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            parts.append(np.packbits(alone, bitorder="little").tobytes())
            left = ~alone[at]
            h1, h2 = h1[left], h2[left]
        return cls(sizes, b"".join(parts))

    def numbers(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for some keys that are not in it, any number for the others."""
        out, open_ = np.full(len(h1), -1, np.int64), np.arange(len(h1))
        for level, size in enumerate(self.sizes):
            at = self.place(h1[open_], h2[open_], level, size) + self.starts[level]
            byte, bit = at >> 3, (at & 7).astype(np.uint8)
            found = (self.packed[byte] >> bit) & 1 == 1
            below = self.packed[byte] & ((np.uint8(1) << bit) - np.uint8(1))
            out[open_[found]] = (self.before[byte] + np.bitwise_count(below))[found]
            open_ = open_[~found]
        return out


_INDEX = "shard long, sizes array<long>, bits binary, prints binary, counts binary, firsts binary"


def fingerprints(h2: np.ndarray) -> np.ndarray:
    return (h2 >> np.uint64(32)).astype("<u4")


def _build(rows: pa.Table) -> pa.Table:
    """One shard: distinct hashes with documents, smallest and largest id, as a perfect hash and its arrays."""
    h1, h2 = (rows.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
    hashed = PerfectHash.build(h1, h2)
    at = hashed.numbers(h1, h2)
    lo, hi, n = (rows.column(c).to_numpy() for c in ("lo", "hi", "n"))
    prints, counts, firsts = np.zeros(len(at), "<u4"), np.zeros(len(at), "<u4"), np.zeros(len(at), "<i8")
    prints[at], firsts[at] = fingerprints(h2), lo
    counts[at] = np.where(lo == hi, 1, np.minimum(n, 0xFFFFFFFF))  # rows with one id are one document
    cols = [
        rows.column("shard")[:1].combine_chunks(), pa.array([hashed.sizes], pa.list_(pa.int64())),
        *(pa.array([x.tobytes()], pa.binary()) for x in (hashed.packed, prints, counts, firsts)),
    ]
    return pa.Table.from_arrays(cols, ["shard", "sizes", "bits", "prints", "counts", "firsts"])


def _distinct(shards: int) -> Callable:
    """Rows of a block's distinct lines, with the smallest and largest id that holds each and how many different ids do."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, n_held, line, hashes in zip(*(batch.column(c) for c in ("ids", "n_held", "line", "hashes"))):
                h1, h2 = _hash_pairs(hashes.as_py())
                if not len(h1):
                    continue
                owner = np.repeat(np.frombuffer(ids.as_py(), np.int64), np.frombuffer(n_held.as_py(), "<u4"))
                held = np.frombuffer(line.as_py(), "<u4").astype(np.int64)
                order = np.lexsort((owner, held))
                owner, held = owner[order], held[order]
                first = np.flatnonzero(np.diff(held, prepend=-1))
                new = np.diff(owner, prepend=owner[0] - 1) != 0
                new[first] = True
                last = np.append(first[1:], len(held)) - 1
                cols = [_shard_of(h1, shards), h1.view(np.int64), h2.view(np.int64), owner[first], owner[last], np.add.reduceat(new.astype(np.int64), first)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["shard", "h1", "h2", "lo", "hi", "n"])

    return task


def line_index(blocks: DataFrame, shards: int) -> DataFrame:
    """One row per shard of about SHARD_LINES distinct lines; blocks are aggregated as they arrive, and never
    exchanged again: the shard that deals them out is the first grouping column."""
    rows = blocks.mapInArrow(_distinct(shards), "shard long, h1 long, h2 long, lo long, hi long, n long")
    rows = rows.repartition(_tasks(blocks, shards), "shard").groupBy("shard", "h1", "h2")
    return rows.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")).groupBy("shard").applyInArrow(_build, _INDEX)


def _tasks(df: DataFrame, shards: int) -> int:
    """Partitions to deal shards to: a bounded number of shards each, and no fewer than the session's own number."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(shards / SHARDS_PER_TASK))


# Probing

_PROBE = "shard long, block long, line binary, hashes binary, sizes array<long>, bits binary, prints binary, counts binary, firsts binary"


def _probes(shards: int) -> Callable:
    """One row per block and shard: numbers of lines and their hashes, side by side."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, hashes in zip(batch.column("block"), batch.column("hashes")):
                h1, h2 = _hash_pairs(hashes.as_py())
                if not len(h1):
                    continue
                shard = _shard_of(h1, shards)
                order = np.argsort(shard, kind="stable")
                first = np.flatnonzero(np.diff(shard[order], prepend=-1))
                line, both = order.astype("<u4"), np.stack([h1, h2], 1)[order]
                parts = [(line[a:b].tobytes(), both[a:b].tobytes()) for a, b in zip(first, np.append(first[1:], len(order)))]
                yield pa.RecordBatch.from_arrays([
                    pa.array(shard[order][first]), pa.array([block.as_py()] * len(parts)), pa.array([p[0] for p in parts], pa.binary()),
                    pa.array([p[1] for p in parts], pa.binary()),
                ], ["shard", "block", "line", "hashes"])

    return task


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows by shard, its arrays first: per probe the lines that several documents hold, and the first of these."""
    hashed = prints = counts = firsts = None
    for batch in batches:
        out: list[tuple[int, bytes, bytes]] = []
        for i in range(batch.num_rows):
            bits = batch.column("bits")[i].as_py()
            if bits is not None:
                hashed = PerfectHash(batch.column("sizes")[i].as_py(), bits)
                prints, counts = (np.frombuffer(batch.column(c)[i].as_py(), "<u4") for c in ("prints", "counts"))
                firsts = np.frombuffer(batch.column("firsts")[i].as_py(), "<i8")
                continue
            h1, h2 = _hash_pairs(batch.column("hashes")[i].as_py())
            at = hashed.numbers(h1, h2)
            known = (at >= 0) & (counts[at] > 1) & (prints[at] == fingerprints(h2))
            if known.any():
                line = np.frombuffer(batch.column("line")[i].as_py(), "<u4")[known]
                out.append((batch.column("block")[i].as_py(), line.tobytes(), firsts[at[known]].tobytes()))
        cols = list(zip(*out)) or [(), (), ()]
        types = [pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["block", "line", "firsts"])


def _drops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that lose lines, and the numbers of these: a line goes in all documents but the first that holds it."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, texts = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("ids", "texts"))
            n_held, at, line = (np.frombuffer(batch.column(c)[i].as_py(), "<u4").astype(np.int64) for c in ("n_held", "at", "line"))
            first = np.full(batch.column("n_hashes")[i].as_py(), np.iinfo(np.int64).max)
            for answer in batch.column("answers")[i].as_py():
                first[np.frombuffer(answer["line"], "<u4")] = np.frombuffer(answer["firsts"], "<i8")
            owner = np.repeat(np.arange(len(ids)), n_held)
            gone = ids[owner] > first[line]
            who, start = np.unique(owner[gone], return_index=True)
            lines = pa.array(at[gone].astype(np.int32))
            ends = pa.array(np.append(start, len(lines)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(ids[who]), pa.array(texts[who]), pa.ListArray.from_arrays(ends, lines)], ["id", "key", "lines"])


def repeated_lines(docs: DataFrame, id_col: str, text_col: str, chars: int = MIN_CHARS, shard_lines: int = SHARD_LINES) -> DataFrame:
    """(id, key, lines): for texts with lines that a document with a smaller id holds, the numbers of these lines.
    key is xxhash64 of the text, so rows with one id and different texts stay apart."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).cast("binary").alias("text"))
    blocks = cut_lineage(rows.where("id IS NOT NULL AND text IS NOT NULL").mapInArrow(_blocks(chars), _BLOCK))
    held = blocks.agg(F.sum("n_hashes")).first()[0] or 0
    shards = max(1, math.ceil(held / shard_lines))
    index = cut_lineage(line_index(blocks, shards))
    probes = blocks.select("block", "hashes").mapInArrow(_probes(shards), "shard long, block long, line binary, hashes binary")
    both = index.unionByName(probes, allowMissingColumns=True).select(*[c.split()[0] for c in _PROBE.split(", ")])
    dealt = both.repartition(_tasks(docs, shards), "shard").sortWithinPartitions("shard", F.col("bits").isNull())
    answers = dealt.mapInArrow(_answer, "block long, line binary, firsts binary")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("line", "firsts")).alias("answers"))
    return blocks.drop("hashes").join(answers, "block").mapInArrow(_drops, "id long, key long, lines array<int>").dropDuplicates(["id", "key"])


# The result

_KEPT = StructType([
    StructField("n_lines", LongType()), StructField("n_dropped", LongType()), StructField("kept_sha256", StringType()), StructField("text", BinaryType()),
])


def drop_lines(text: bytes | None, gone: list[int] | None) -> tuple[int, int, str, bytes | None]:
    """Lines, lines dropped, digest of the rest joined by line ends, and the rest; null without lines to drop stays null."""
    n = (text or b"").count(b"\n") + 1
    if not gone:
        return n, 0, hashlib.sha256(text or b"").hexdigest(), text
    out = set(gone)
    rest = b"\n".join([line for i, line in enumerate(text.split(b"\n")) if i not in out])
    return n, len(out), hashlib.sha256(rest).hexdigest(), rest


@F.arrow_udf(_KEPT)
def _kept(texts: pa.Array, gone: pa.Array) -> pa.Array:
    out = [drop_lines(t.as_py(), g.as_py()) for t, g in zip(texts, gone)]
    cols = list(zip(*out)) or [(), (), (), ()]
    types = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["n_lines", "n_dropped", "kept_sha256", "text"])


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have."""
    while name.lower() in [c.lower() for c in docs.columns]:
        name += "_"
    return name


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars: int = MIN_CHARS, shard_lines: int = SHARD_LINES
) -> DataFrame:
    """docs without repeated lines, plus n_lines (before), n_dropped and kept_sha256 (columns of these names are replaced).

    A line's key is the line without white space at its ends, A-Z in lower case. Lines whose key has at least
    `chars` code points and occurs in several documents stay only in the one with the smallest id, as often
    as it holds them. All other lines stay as they are, joined by line ends.

    A null or empty text is one empty line; a null text stays null. Rows with one id count as one document, and
    rows with a null id lose nothing and cost no other row anything. Other columns stay, whatever their names;
    an empty table gives an empty one. Lines are compared by 128-bit hashes.
    """
    gone = repeated_lines(docs, id_col, text_col, chars, shard_lines)
    id_, key, lines, kept = (_free(docs, n) for n in ("id_", "key_", "lines_", "kept_"))
    gone = gone.select(F.col("id").alias(id_), F.col("key").alias(key), F.col("lines").alias(lines))
    on: Column = (F.col(id_col).cast("long") == F.col(id_)) & (F.xxhash64(text_col) == F.col(key))
    joined = docs.join(gone, on, "left").withColumn(kept, _kept(F.col(text_col).cast("binary"), F.col(lines)))
    return joined.withColumns({
        text_col: F.col(f"{kept}.text").cast("string"), "n_lines": F.col(f"{kept}.n_lines"), "n_dropped": F.col(f"{kept}.n_dropped"),
        "kept_sha256": F.col(f"{kept}.kept_sha256"),
    }).drop(id_, key, lines, kept)
