import itertools
import os

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shardleaf.llm.mixing import mix, source_targets, taken_words
from shardleaf.llm.packing import best_bounds, fit_buckets, length_bin, pack
from shardleaf.llm.queries import QUERIES, SQL, table


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS FROM '{sf}/{f}'")
    ours = QUERIES[name](spark, sf)
    cols = sorted(ours.columns)
    theirs = con.sql(SQL[name]).project(", ".join(cols)).fetchall()
    assert theirs and sorted(map(repr, (tuple(r) for r in ours.select(cols).collect()))) == sorted(map(repr, theirs))


def plain_targets(sizes, weights=(5, 2, 1)):
    """Targets by resharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    rest, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s] or sizes[s] == 0]
        if not over:
            return target | share
        for s in over:
            target[s] = 2 * sizes[s]
            rest -= target[s]
            open_.discard(s)
    return target


@settings(max_examples=12, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text(alphabet="abÉz\U0001F600", max_size=2)), st.integers(0, 10_000), max_size=7))
def test_targets(spark, sizes):
    rows = source_targets(spark.createDataFrame([*sizes.items()], "source string, size long")).collect()
    want = plain_targets(sizes)
    assert {r.source: r.target for r in rows} == pytest.approx(want)


def test_mix_takes_what_the_targets_say(spark, sf):
    got = taken_words(mix(table(spark, sf, "documents"))).toPandas()
    assert (got.taken <= 2 * got["size"]).all()
    per = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(per.taken - per.target) <= 1).all()


def test_schedule(spark, sf):
    """Every slot once, blocks of equal words, and every prefix of the schedule close to the weights."""
    mixed = mix(table(spark, sf, "documents"), min_slots=500)
    slots = mixed.pieces.groupBy("slot", "src", "block").agg(F.sum("taken").alias("n")).toPandas()
    assert slots.slot.is_unique and not slots.duplicated(["src", "block"]).any()
    assert slots.n.max() == mixed.block_words and (slots.n == mixed.block_words).sum() >= len(slots) - slots.src.nunique()
    for src, mine in slots.groupby("src"):
        assert sorted(mine.block) == list(range(len(mine))) and mine.sort_values("slot").block.is_monotonic_increasing
        order = slots.sort_values("slot").src.to_numpy()
        drift = np.cumsum(order == src) - np.arange(1, len(order) + 1) * len(mine) / len(order)
        assert np.abs(drift).max() <= 8


def test_mix_edge_cases(spark):
    rows = [(1, "a b c", None, 7), (1, "a b c", None, 7), (2, None, "s", 7), (None, "x y", "s", 7), (3, "", "t", 7), (4, "q " * 50_000, "u", 7), (None, "x y", "s", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = taken_words(mix(docs)).toPandas()
    assert len(got) == len(rows) and (got.taken <= 2 * got["size"]).all() and got.taken.sum() == pytest.approx(1.5 * got["size"].sum(), abs=2)
    again = taken_words(mix(docs)).toPandas()
    assert sorted(map(tuple, got.astype(str).values)) == sorted(map(tuple, again.astype(str).values))
    assert taken_words(mix(spark.createDataFrame([], "doc_id long, text string, source string"))).count() == 0
    assert taken_words(mix(docs.where("doc_id = 2"))).first()["taken"] == 0


def brute_bounds(lengths, buckets):
    values = sorted(set(lengths))
    best = None
    for k in range(1, min(buckets, len(values)) + 1):
        for cuts in itertools.combinations(values[:-1], k - 1):
            bounds = [*cuts, values[-1]]
            cost = sum(min(b for b in bounds if b >= n) - n for n in lengths)
            best = cost if best is None else min(best, cost)
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=25), st.integers(1, 5))
def test_bounds_are_optimal(lengths, buckets):
    values, counts = np.unique(lengths, return_counts=True)
    found = best_bounds(values, counts, values * counts, buckets)
    assert found.padding == brute_bounds(lengths, buckets) and len(found.bounds) <= buckets
    assert found.padding == sum(min(b for b in found.bounds if b >= n) - n for n in lengths)


def test_bins(spark):
    rows = spark.range(1, 60_000, 7).select(F.col("id").alias("n"), length_bin(F.col("id")).alias("b")).toPandas()
    assert (rows.b >= rows.n).all() and (rows.b[rows.n < 4096] == rows.n[rows.n < 4096]).all()
    assert ((rows.b - rows.n) / rows.n < 1 / 1024).all() and rows.b.is_monotonic_increasing


def test_packing(spark, sf):
    got = QUERIES["op2_packing"](spark, sf).toPandas()
    docs = table(spark, sf, "documents").count()
    assert len(got) == docs and (got.n_words <= got.bucket_length).all() and (got.padding == got.bucket_length - got.n_words).all()
    batches = got.groupby(["bucket", "batch"]).agg(n=("doc_id", "size"), length=("bucket_length", "first"), places=("place", "max"))
    assert ((batches.n * batches.length <= 16_384) | (batches.n == 1)).all() and (batches.places + 1 == batches.n).all()
    for _, mine in batches.groupby("bucket"):
        assert sorted(mine.index.get_level_values(1)) == list(range(len(mine)))
        assert (mine.n.to_numpy()[:-1] == max(1, 16_384 // mine.length.iloc[0])).all(), "only the last batch of a bucket is not full"
    assert got.padding.sum() == fit_buckets(got_frame(spark, got), "n_words").padding


def got_frame(spark, got):
    return spark.createDataFrame(got[["doc_id", "n_words"]])


def test_packing_edge_cases(spark):
    rows = [(1, 5, "x"), (1, 5, "x"), (None, 7, "y"), (2, None, "z"), (3, 0, "z"), (4, 10**9, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, n long, bucket string")
    got = pack(docs, "n", budget=20).toPandas()
    assert len(got) == 6 and set(got[got.n.fillna(0) == 0].bucket) == {0} and got[got.n == 10**9].place.tolist() == [0]
    assert pack(spark.createDataFrame([], "doc_id long, n long"), "n").count() == 0
