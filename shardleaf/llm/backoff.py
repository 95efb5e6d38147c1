"""Stupid-backoff language-model scores, computed relationally.

The score of a word after another is count(pair) / count(first) if the pair occurs min_count times in the
corpus, else 0.4 * count(word) / all words; a document's score is the sum of the logarithms. Words are
runs of letters and digits in lower case. Counts of words and of pairs cover the whole corpus and grow with
it; none is pooled or left out.

N-grams are exploded per block of texts, one row for each distinct one of a block with the documents that
hold it, and partitioned by hash. There the rows' occurrences add up to the n-gram's count, which joins back
to its rows, and what it adds to each document is summed per document. The VOCABULARY most frequent words
have numbers, and a broadcast table of their counts of proven size. All other words, the rare ones, have no
count outside the shuffle: a pair that holds one is partitioned by that word, whose rows as a first or last word
add up to its count (a pair of two rare words has a row for either). A rare word has at most a VOCABULARY-th
of all words. A pair of two words that are among the most frequent (each a thousandth of all
words, so a thousand at most) could be a hot key: such pairs, a million at most, are counted by partial
sums beforehand and scored where they stand. No other pair can hold more than a thousandth of all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..plans import cut_lineage
from . import words

VOCABULARY = 1 << 17
MIN_COUNT = 2
DISCOUNT = 0.4
HOT = 1024
BLOCK_BYTES = 1 << 23
SIGN = np.uint64(1 << 63)
EVEN = np.uint64((1 << 64) - 2)
SPREAD = 1 << 15  # ids in a block of pairs lie within this distance, so that a document takes 2 bytes


@dataclass
class Words:
    """hashes: sorted, of the words with a number; counts: theirs; total: all words; hot: for each number its rank among
    the frequent words, or -1, then -1 for rare words; pairs: counts of pairs of frequent words, by rank."""

    hashes: np.ndarray
    counts: np.ndarray
    total: int
    hot: np.ndarray
    pairs: np.ndarray | None = None
    min_count: int = MIN_COUNT

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Number of each word; len(hashes) for rare words."""
        if not len(self.hashes):
            return np.zeros(len(h), np.int32)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1).astype(np.int32)
        return np.where(self.hashes[at] == h, at, np.int32(len(self.hashes)))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids ascending, owner of each word, word hashes) of groups of texts with ids close together."""
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        order = np.argsort(ids, kind="stable")
        texts, ids = [batch.column("text")[int(i)].as_py() for i in order], ids[order]
        for a, b in words.groups(texts, BLOCK_BYTES):
            while a < b:
                c = a + int(np.searchsorted(ids[a:b], ids[a] + SPREAD))
                owner, hashes = [], []
                for x, y in words.groups(texts[a:c]):
                    block = words.block(texts[a + x : a + y], words.PUNCTUATION)
                    owner.append((block.owner + x).astype(np.int32))
                    hashes.append((block.hashes(0, words.LOWER) | SIGN) & EVEN)  # negative as a long, so never a number; the last bit is for the side
                yield ids[a:c], np.concatenate(owner), np.concatenate(hashes)
                a = c


def _batch(**cols: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols.values()], list(cols))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, h in _blocks(batches):
        kinds, n = np.unique(h, return_counts=True)
        yield _batch(word=kinds.view(np.int64), n=n)


def _pairs_of(owner: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, second word) of each pair inside a text."""
    inside = np.flatnonzero(owner[1:] == owner[:-1])
    return owner[inside], number[inside], number[inside + 1]


def _count_hot(known: Words) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(HOT * HOT, np.int64)
        for _, owner, h in _blocks(batches):
            _, a, b = _pairs_of(owner, known.numbers(h))
            ra, rb = known.hot[a], known.hot[b]
            both = (ra >= 0) & (rb >= 0)
            total += np.bincount(ra[both] * HOT + rb[both], minlength=HOT * HOT)
        some = np.flatnonzero(total)
        yield _batch(pair=some, n=total[some])

    return task


def _local(known: Words) -> Callable:
    """(id, words, score) that need no shuffle: every word with a number as if backed off, pairs of frequent words as counted."""
    single = np.append(np.log(DISCOUNT * known.counts / max(1, known.total)), 0.0)  # rare words follow with their counts

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, owner, h in _blocks(batches):
            number = known.numbers(h)
            score = np.bincount(owner, single[number], len(ids)).astype(float)  # without words it counts in whole numbers
            head = np.ones(len(owner), bool)
            head[1:] = owner[1:] != owner[:-1]
            score -= np.bincount(owner[head], minlength=len(ids)) * np.log(DISCOUNT)  # the first word has nothing to back off from
            text, a, b = _pairs_of(owner, number)
            ra, rb = known.hot[a], known.hot[b]
            both = (ra >= 0) & (rb >= 0)
            text, a, b = text[both], a[both], b[both]
            n = known.pairs[ra[both] * HOT + rb[both]]
            found = n >= known.min_count
            gain = np.log(n[found] / known.counts[a[found]]) - single[b[found]]
            score += np.bincount(text[found], gain, len(ids))
            yield _batch(id=ids, n_words=np.bincount(owner, minlength=len(ids)), score=score)

    return task


def _held(key: np.ndarray, text: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Distinct keys in order, and for each the ids that hold it as distances from the first id, as often as they do."""
    order = np.argsort(key, kind="stable")
    key, text = key[order], text[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    docs = pa.ListArray.from_arrays(pa.array(np.append(first, len(key)).astype(np.int32)), pa.array((ids[text] - ids[0]).astype(np.int16)))
    return key[first], docs


def _explode(known: Words) -> Callable:
    """(word, other, base, docs): each distinct n-gram of a block, and the ids that hold it as distances from base, as often as they do.

    A pair of two words with numbers has its number in `word` and no other; a rare word that ends a text has its hash
    there and no other; a pair with a rare word has that word there, and in other the second word, or the first one
    and a last bit of 1. Words in `other` are hashes, which are negative, or twice their number.
    """
    size = len(known.hashes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, owner, h in _blocks(batches):
            number = known.numbers(h)
            rare = np.flatnonzero(number == size)
            kinds, at = np.unique(h[rare], return_inverse=True)
            number[rare] += at.astype(np.int32)
            ends = np.append(owner[1:] != owner[:-1], True)[rare] if len(rare) else np.zeros(0, bool)
            kinds, code = kinds.view(np.int64), np.concatenate([np.arange(size) * 2, kinds.view(np.int64)])
            word, docs = _held(at[ends], owner[rare[ends]], ids)
            yield from _rows(kinds[word], None, docs, ids[0])
            text, a, b = _pairs_of(owner, number)
            del number, owner, h, rare, at
            some = np.flatnonzero(a >= size)
            pair, docs = _held((a[some].astype(np.int64) - size) * len(code) + b[some], text[some], ids)
            yield from _rows(kinds[pair // len(code)], code[pair % len(code)], docs, ids[0])
            some = np.flatnonzero(b >= size)
            pair, docs = _held((b[some].astype(np.int64) - size) * len(code) + a[some], text[some], ids)
            yield from _rows(kinds[pair // len(code)], code[pair % len(code)] | 1, docs, ids[0])
            cold = (a < size) & (b < size)
            cold &= (known.hot[np.minimum(a, size)] < 0) | (known.hot[np.minimum(b, size)] < 0)
            some = np.flatnonzero(cold)
            pair, docs = _held(a[some].astype(np.int64) * size + b[some], text[some], ids)
            yield from _rows(pair, None, docs, ids[0])

    return task


def _rows(word: np.ndarray, other: np.ndarray | None, docs: pa.Array, base: int) -> Iterator[pa.RecordBatch]:
    for x in range(0, len(word), 1 << 15):
        some = word[x : x + (1 << 15)]
        other_ = pa.nulls(len(some), pa.int64()) if other is None else pa.array(other[x : x + (1 << 15)])
        cols = [pa.array(some), other_, pa.array(np.full(len(some), base, np.int64)), docs.slice(x, 1 << 15)]
        yield pa.RecordBatch.from_arrays(cols, ["word", "other", "base", "docs"])


def count_words(rows: DataFrame, vocabulary: int = VOCABULARY, min_count: int = MIN_COUNT) -> Words:
    """Words with a number and pairs of frequent ones: rows on the driver are bounded by the vocabulary and by HOT * HOT."""
    counts = cut_lineage(rows.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total = int(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    top = counts.orderBy(F.col("n").desc(), "word").limit(vocabulary).toPandas()
    hashes = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    n = top["n"].to_numpy(np.int64)[order]
    known = Words(hashes[order], n, total, np.full(len(n) + 1, -1), min_count=min_count)
    frequent = np.flatnonzero(known.counts * 1000 >= max(1, total))
    known.hot[frequent] = np.arange(len(frequent))
    hot = rows.mapInArrow(_count_hot(known), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    known.pairs = np.zeros(HOT * HOT, np.int64)
    known.pairs[hot["pair"].to_numpy(np.int64)] = hot["n"].to_numpy(np.int64)
    return known


def backoff_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: int = VOCABULARY, min_count: int = MIN_COUNT
) -> DataFrame:
    """(id, n_words, log_score, perplexity): stupid-backoff scores of whole texts under the counts of all of them.

    log_score is the sum over words of the natural log of the score, perplexity exp(-log_score / n_words).
    A pair counts as seen from min_count occurrences on: the corpus scores itself, so with 1 no pair would ever
    back off. The vocabulary says how many words have their counts broadcast; it does not change the scores.
    Rows with one id are parts of one document: their sums add up, no pair spans two of them. Texts of
    null or without words score 0 and have no perplexity. Rows with a null id are counted like any other
    but have no document to sum for, and come back as one row of null id with nulls. An empty table gives an
    empty one. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    nameless = rows.where("id IS NULL").select(F.lit(None).cast("long").alias("id")).limit(1)
    least = F.lit(-(1 << 62)).cast("long")
    rows = rows.withColumn("id", F.coalesce("id", least))
    known = count_words(rows, vocabulary, min_count)
    local = rows.mapInArrow(_local(known), "id long, n_words long, score double")
    exploded = rows.mapInArrow(_explode(known), "word long, other long, base long, docs array<short>")
    size = len(known.hashes)
    # One sort inside the partitions by word: the n-gram's count, then that of the rare word it is kept under.
    times, rare = F.size("docs"), F.col("word") < 0
    is_second = F.coalesce(F.col("other") % 2 != 0, F.lit(False))  # the rare word; the other one comes before it
    counted = exploded.repartition("word").withColumn("_n", F.sum(times).over(Window.partitionBy("word", "other")))
    counted = counted.withColumn("_own", F.sum(F.when(~is_second, times)).over(Window.partitionBy("word")))
    seen = (~rare | F.col("other").isNotNull()) & (F.col("_n") >= min_count)
    found = counted.where(seen | (rare & ~is_second))
    # What a found pair adds: log(count / count of the first word), less what its second word has as if backed off.
    numbers = pd.DataFrame({"number": np.arange(size), "log_count": np.log(known.counts.astype(float))})
    numbers = docs.sparkSession.createDataFrame(numbers, "number long, log_count double")  # as many rows as the vocabulary
    first = numbers.select(F.col("number").alias("_a"), F.col("log_count").alias("_first"))
    second = numbers.select(F.col("number").alias("_b"), F.col("log_count").alias("_second"))
    numbered = F.when(F.col("other") >= 0, F.shiftright("other", 1))
    found = found.withColumns({
        "_a": F.when(~rare, F.expr(f"word div {max(1, size)}")).when(is_second, numbered),
        "_b": F.when(~rare, F.col("word") % max(1, size)).when(~is_second, numbered),
    })
    found = found.join(F.broadcast(first), "_a", "left").join(F.broadcast(second), "_b", "left")
    offset = float(np.log(DISCOUNT / max(1, known.total)))
    score = (
        F.when(~rare, F.log("_n") - offset - F.col("_first") - F.col("_second"))
        # Its share of the pair is what it has as if backed off; the row of a rare first word has the rest.
        .when(is_second, F.when(F.col("other") < 0, 0.0).otherwise(F.log("_n") - offset - F.col("_first")) - F.log("_own"))
        # A first word's row has the word itself too, as if backed off: its count cancels in a pair that was seen.
        .when(seen, F.log("_n") - F.coalesce("_second", F.lit(0.0)))
        .otherwise(F.log("_own") + offset)
    )
    each = found.select(score.alias("score"), "base", F.explode("docs").alias("_d"))
    pairs = each.groupBy((F.col("base") + F.col("_d")).alias("id")).agg(F.sum("score").alias("score"))
    both = local.unionByName(pairs.select("id", F.lit(0).cast("long").alias("n_words"), "score"))
    out = both.groupBy("id").agg(F.sum("n_words").alias("n_words"), F.sum("score").alias("log_score")).where(F.col("id") != least)
    per_word = F.when(F.col("n_words") > 0, F.exp(-F.col("log_score") / F.col("n_words")))
    out = out.withColumn("perplexity", per_word).unionByName(
        nameless.select("id", F.lit(None).cast("long").alias("n_words"), F.lit(None).cast("double").alias("log_score"), F.lit(None).cast("double").alias("perplexity"))
    )
    return out.withColumnRenamed("id", id_col)
