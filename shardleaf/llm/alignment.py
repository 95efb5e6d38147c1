"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text, counted over all texts.

Both tokenizers encode the whole text. Where tokens of both end and both next tokens start with a space,
the text is cut, so it becomes a sequence of windows, about one per word, and each window is a pair of id
tuples. Its groups and links depend on these ids alone, so a task finds them once per pair of tuples of a block of
texts, for all new windows at once, and keeps each text as numbers of windows.

A block then sends one row per pair of ids that it links, with how often; the counts of the corpus come
back as one row per pair and block, and the block adds them up over its windows and texts. So no text is
shuffled, no token is a row, and the most frequent pair is one row per block.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from ..plans import cut_lineage
from . import words

BLOCK_BYTES = 2 << 20  # text in a block
PART_BYTES = 1 << 19  # text encoded at a time
#: Fixed value: how a byte-level vocabulary splits a text before its merges.
BYTE_LEVEL_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: visible Latin-1 characters stand for
    themselves, all other bytes for the characters from U+0100 up, in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(visible))
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


@dataclass
class Tokenizer:
    """encode turns a text into ids; pieces are the bytes of each id."""

    encode: Callable[[str], list[int]]
    pieces: list[bytes]

    def __post_init__(self) -> None:
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.spaced = np.array([p[:1] == b" " for p in self.pieces])


def byte_level(file: bytes) -> Tokenizer:
    """A byte-level BPE vocabulary (JSON). Its merges must be in the order of their ids, so that ids are ranks.

    The text gets a space before it. Special tokens are not used, their strings are plain text.
    """
    spec, letters = json.loads(file), byte_of_letter()
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ids = spec["model"]["vocab"]
    ranks = {bytes(letters[c] for c in token): i for token, i in ids.items() if token not in special}
    merged = [ids["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
    level = spec.get("pre_tokenizer") or {}
    if merged != sorted(merged) or spec.get("normalizer") or level.get("type") != "ByteLevel" or not level.get("use_regex", True):
        raise ValueError("not a byte-level vocabulary with merges in the order of their ids")
    pieces = [b""] * (max(ids.values()) + 1)
    for token, i in ranks.items():
        pieces[i] = token
    encoding = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Tokenizer(lambda text: encoding.encode_ordinary(" " + text), pieces)


def piece_level(file: bytes) -> Tokenizer:
    """A SentencePiece model, which itself puts a space before the text. Pieces of one byte are that byte."""
    model = sentencepiece.SentencePieceProcessor(model_proto=file)
    def piece(i: int) -> bytes:
        text = model.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if model.is_byte(i) else text.replace("▁", " ").encode()

    return Tokenizer(model.encode, [piece(i) for i in range(model.get_piece_size())])


@lru_cache(maxsize=1)
def _load(a_file: bytes, b_file: bytes) -> tuple[Tokenizer, Tokenizer]:
    return byte_level(a_file), piece_level(b_file)


COMMA, BAR, SEMICOLON = b",|;"


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers of 4 bytes, compressed: all lowest bytes first, so that the rare high ones lie together."""
    planes = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def _decimals(top: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of all ids below top, left-aligned in rows with room for a separator, and their lengths."""
    digits = np.array([str(i).ljust(len(str(top)) + 1) for i in range(top)], "S")
    return digits.view(np.uint8).reshape(top, -1), np.char.str_len(np.char.rstrip(digits)).astype(np.int64)


class Aligner:
    """Two tokenizers, and windows of their ids. A window's key is the ids of A, a separator that is no id, and the ids of B."""

    def __init__(self, a: Tokenizer, b: Tokenizer) -> None:
        self.a, self.b = a, b
        top = max(len(a.pieces), len(b.pieces))
        self.type = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.separator = np.iinfo(self.type).max
        self.digits, self.n_digits = _decimals(top)

    def encode(self, text: bytes | None) -> tuple[list[int], list[int]] | None:
        """Ids of A and B if both stand for a space and the text, byte by byte."""
        if not text:
            return None
        try:
            string = text.decode()
        except UnicodeDecodeError:
            return None
        ids = self.a.encode(string), self.b.encode(string)
        want = b" " + text
        if any(b"".join([t.pieces[i] for i in found]) != want for t, found in zip((self.a, self.b), ids)):
            return None
        return ids

    def cut(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Tokens of A, of B and windows of each text, and the keys of all windows in order."""
        both = [self.encode(t) for t in texts]
        n_a, n_b = (np.array([len(ids[k]) if ids else 0 for ids in both], np.int64) for k in (0, 1))
        if not n_a.any():
            return n_a, n_b, np.zeros(len(texts), np.int64), []
        a, b = (np.concatenate([np.array(ids[k], self.type) for ids in both if ids]) for k in (0, 1))
        del both
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        stop_a, stop_b = np.append(self.a.spaced[a[1:]], True), np.append(self.b.spaced[b[1:]], True)
        stop_a[np.cumsum(n_a)[n_a > 0] - 1] = stop_b[np.cumsum(n_b)[n_b > 0] - 1] = True
        anchors = np.intersect1d(ends_a[stop_a], ends_b[stop_b], assume_unique=True)
        at_a, at_b = np.searchsorted(ends_a, anchors) + 1, np.searchsorted(ends_b, anchors) + 1
        n_windows = np.diff(np.searchsorted(at_a, np.cumsum(n_a), side="right"), prepend=0)
        size, sep, keys = self.type.itemsize, self.type.type(self.separator).tobytes(), []
        raw_a, raw_b, p, q = a.tobytes(), b.tobytes(), 0, 0
        for i, j in zip((at_a * size).tolist(), (at_b * size).tolist()):
            keys.append(raw_a[p:i] + sep + raw_b[q:j])
            p, q = i, j
        return n_a, n_b, n_windows, keys

    def align(self, keys: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Of each window: groups as text, their number, and the number of links; and the links of all, (id of A) << 32 | (id of B).

        Tokens lie side by side, so between two neighbouring ends, of whichever side, there is one link.
        """
        sep = np.array([self.separator], self.type)
        ids = np.frombuffer(b"".join([k + sep.tobytes() for k in keys]), self.type)
        cuts = np.flatnonzero(ids == self.separator)
        bars, stops = cuts[0::2], cuts[1::2]
        side = np.zeros(len(ids) + 1, np.int8)  # 1 within A, 0 within B
        side[np.append(0, stops[:-1] + 1)] = 1
        side[bars] = -1
        real = ids != self.separator
        in_a = np.cumsum(side[:-1]) > 0
        a, b = ids[in_a & real].astype(np.int64), ids[~in_a & real].astype(np.int64)
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        last_a = np.cumsum(bars - np.append(0, stops[:-1] + 1))
        window_ends = ends_a[last_a - 1]
        ends = np.union1d(ends_a, ends_b)
        links = a[np.searchsorted(ends_a, ends)] << 32 | b[np.searchsorted(ends_b, ends)]
        n_links = np.diff(np.searchsorted(ends, window_ends, side="right"), prepend=0)
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        n_groups = np.diff(np.searchsorted(shared, window_ends, side="right"), prepend=0)
        return self._texts(a, b, ends_a, ends_b, shared, window_ends), n_groups, n_links, links

    def _texts(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, shared: np.ndarray, window_ends: np.ndarray) -> list[bytes]:
        """Groups of each window as text: ids of A, a bar, ids of B; groups side by side."""
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        to_a, to_b = np.searchsorted(group_a, np.arange(len(shared)), side="right"), np.searchsorted(group_b, np.arange(len(shared)), side="right")
        place_a = np.arange(len(a)) + np.append(0, to_b)[group_a]
        place_b = np.arange(len(b)) + to_a[group_b]
        ids, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), COMMA, np.uint8)
        ids[place_a], ids[place_b] = a, b
        mark[place_a[to_a - 1]], mark[place_b[to_b - 1]] = BAR, SEMICOLON
        chars, n = self.digits[ids], self.n_digits[ids]
        chars[np.arange(len(ids)), n] = mark
        raw = chars[np.arange(chars.shape[1]) <= n[:, None]].tobytes()
        last = place_b[to_b[np.searchsorted(shared, window_ends)] - 1]
        stops = np.cumsum(n + 1)[last].tolist()
        return [raw[i : j - 1] for i, j in zip([0, *stops], stops)]


@lru_cache(maxsize=1)
def _aligner(a_file: bytes, b_file: bytes) -> Aligner:
    return Aligner(byte_level(a_file), piece_level(b_file))


class _Block:
    """Windows of a block of texts, numbered as they come; each is aligned once."""

    def __init__(self, aligner: Aligner) -> None:
        self.aligner, self.numbers = aligner, {}
        self.texts: list[bytes] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Tokens of A, of B, windows of each text, the numbers of all windows, and the digests of the texts' groups."""
        n_a, n_b, n_windows, keys = self.aligner.cut(texts)
        known, numbers = len(self.numbers), self.numbers
        order = [numbers.setdefault(k, len(numbers)) for k in keys]
        if len(numbers) > known:
            held, *counts = self.aligner.align(list(islice(reversed(numbers), len(numbers) - known))[::-1])
            self.texts += held
            self.parts.append(tuple(counts))
        digests, at, held = [], 0, self.texts
        for n in n_windows.tolist():
            digests.append(sha256(b";".join([held[i] for i in order[at : at + n]])).hexdigest() if n else "")
            at += n
        return n_a, n_b, n_windows, np.array(order, np.int64), digests


def _row(block: _Block, texts: list[bytes | None]) -> dict:
    """A block as a row: counts per text, the numbers of its windows, links per window, and pairs of ids with their counts."""
    parts = [block.add(texts[lo:hi]) for lo, hi in words.groups(texts, PART_BYTES)]
    n_a, n_b, n_windows, order = (np.concatenate([p[k] for p in parts]) for k in range(4))
    none = [np.zeros(0, np.int64)]
    n_groups, n_links, links = (np.concatenate(none + [p[k] for p in block.parts]) for k in range(3))
    pairs, number = np.unique(links, return_inverse=True)
    totals = np.zeros(len(pairs), np.int64)
    np.add.at(totals, number, np.repeat(np.bincount(order, minlength=len(n_links)), n_links))
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": _per_text(n_groups[order], n_windows), "n_links": _per_text(n_links[order], n_windows),
        "digests": [d for p in parts for d in p[4]], "n_windows": n_windows, "window": _pack(order),
        "n_pairs": _pack(n_links), "number": _pack(number), "pairs": pairs, "totals": totals,
    }


def _per_text(of_window: np.ndarray, n_windows: np.ndarray) -> np.ndarray:
    """Sums over the windows of each text."""
    before, stops = np.concatenate([[0], np.cumsum(of_window)]), np.cumsum(n_windows)
    return before[stops] - before[stops - n_windows]


_LONGS = ["n_a", "n_b", "n_groups", "n_links", "n_windows", "pairs", "totals"]
_PACKED = ["window", "n_pairs", "number"]


def _block_schema(id_field: StructField) -> StructType:
    return StructType([
        StructField("block", LongType()), StructField("ids", ArrayType(id_field.dataType)), StructField("digests", ArrayType(StringType())),
        *[StructField(n, ArrayType(LongType())) for n in _LONGS], *[StructField(n, BinaryType()) for n in _PACKED],
    ])


def _blocks(a_file: bytes, b_file: bytes) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = _aligner(a_file, b_file), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            for lo, hi in words.groups(texts, BLOCK_BYTES):
                row = _row(_Block(aligner), texts[lo:hi])
                ids = pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), batch.column("id")[lo:hi])
                lists = [pa.ListArray.from_arrays(pa.array([0, len(row[c])], pa.int32()), pa.array(row[c], pa.int64())) for c in _LONGS]
                packed = [pa.array([row[c]], pa.binary()) for c in _PACKED]
                digests = pa.array([row["digests"]], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array([number]), ids, digests, *lists, *packed], ["block", "ids", "digests", *_LONGS, *_PACKED])
                number += 1

    return task


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of blocks with the sums over their links."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            window, n_pairs, number = (_unpack(row[c].as_py()) for c in _PACKED)
            n_windows, sums = row["n_windows"].values.to_numpy(), []
            for name in ("best", "n"):
                of_pair = np.zeros(int(number.max(initial=-1)) + 1, np.int64)
                if len(of_pair):
                    scores = row["scores"].values
                    of_pair[scores.field("number").to_numpy()] = scores.field(name).to_numpy()
                sums.append(pa.array(_per_text(_per_text(of_pair[number], n_pairs)[window], n_windows)))
            lists = [row[c].values for c in ("ids", "n_a", "n_b", "n_groups", "n_links")]
            names = ["ids", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([*lists, *sums, row["digests"].values], names)


def pair_counts(held: DataFrame) -> DataFrame:
    """(pair, n, best): links of the corpus that hold each pair of ids, and whether (1 or 0) that is the most of its id of B.
    The most per id of B are at most as many rows as B has ids, a proven bound for the broadcast."""
    counts = cut_lineage(held.groupBy("pair").agg(F.sum("n").alias("n")))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b")
    most = counts.groupBy(b).agg(F.max("n").alias("_most"))
    best = (F.col("n") == F.col("_most")).cast("long").alias("best")
    return cut_lineage(counts.select("*", b).join(F.broadcast(most), "b").select("pair", "n", best))


def align_tokens(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    a_file is a byte-level BPE vocabulary, b_file a SentencePiece model, on the driver; the tasks get their
    bytes. Texts are encoded whole. n_links: pairs of tokens whose bytes overlap. count_sum adds up, over links,
    how many links of the corpus hold the same ids; n_best counts those links where no other pair of that id of B
    has more. groups_sha256 is the digest of `a1,a2|b1;a3|b2`: ids between offsets at which tokens of both end.

    Texts that are null, empty, no UTF-8, or that a tokenizer changes have no tokens: zeros and an empty digest.
    Rows are not identified by their id: it may be null or repeated, and each row counts. Other columns are not
    read, so their names do not matter; an empty table gives an empty one.
    """
    a, b = (open(f, "rb").read() for f in (a_file, b_file))
    id_field = docs.schema[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    blocks = cut_lineage(rows.mapInArrow(_blocks(a, b), _block_schema(id_field)))
    held = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "totals")).alias("number", "_p"))
    held = held.select("block", "number", F.col("_p.pairs").alias("pair"), F.col("_p.totals").alias("n"))
    scored = held.drop("n").join(pair_counts(held), "pair")
    scored = scored.groupBy("block").agg(F.collect_list(F.struct("number", "n", "best")).alias("scores"))
    out = StructType([
        StructField("ids", id_field.dataType), *[StructField(n, LongType()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        StructField("groups_sha256", StringType()),
    ])
    return blocks.drop("pairs", "totals").join(scored, "block", "left").mapInArrow(_sums, out).withColumnRenamed("ids", id_col)
