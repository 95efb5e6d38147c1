"""Near-duplicates by similarity, against brute-force Jaccard."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from shardleaf.llm import near, simhash, substrings, words
from shardleaf.llm.queries import table
from shardleaf.llm.substrings import remove_repeats
from shardleaf.plans import bounds, cut_lineage


def plain_set(text, width=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


def plain_kept(rows, width=5, similarity=0.8):
    """Smallest id of each group that links of the similarity connect; rows are (id, text)."""
    rows = sorted(rows)
    sets = [plain_set(t, width) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= similarity:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [rows[i][0] for i in range(len(rows)) if find(i) == i]


@pytest.fixture(scope="module")
def edited():
    """Texts of 12 to 400 words, each with copies of which 1 to 12 % of the words are changed."""
    rng, rows = np.random.default_rng(11), []
    for n in [12, 20, 40, 100, 100, 400] * 8:
        base = [f"w{x}" for x in rng.integers(0, 10**6, n)]
        rows.append(" ".join(base))
        for share in (0.01, 0.02, 0.03, 0.06, 0.12):
            copy = list(base)
            for k in rng.choice(n, max(1, int(share * n)), replace=False):
                copy[k] = f"W{rng.integers(10**6)}x"
            rows.append(" ".join(copy))
    return [(int(i), t) for i, t in zip(rng.permutation(len(rows)), rows)]


def test_stage_equals_brute_force_on_edited_copies(spark, sf, edited):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in edited], "doc_id long, text string, lang string, source string, n_chars long")
    want = plain_kept(edited)
    assert sorted(r.doc_id for r in cp.near_duplicates(spark, docs, sf).collect()) == want
    two_bits = sorted(r.doc_id for r in simhash.one_per_group(docs).collect())
    assert len(want) < len(two_bits), "copies that 2 bits do not find"


def test_stage_equals_brute_force_on_documents(spark, sf):
    docs = table(spark, sf, "documents")
    want = plain_kept([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in cp.near_duplicates(spark, docs, sf).collect()) == want


def test_one_changed_word_in_a_hundred(spark, sf):
    base = [f"word{i}" for i in range(100)]
    rows = [(k, " ".join(base[:k] + [f"other{k}"] + base[k + 1 :])) for k in range(10, 90, 10)]
    docs = spark.createDataFrame([(0, " ".join(base)), *rows], "doc_id long, text string")
    assert [r.doc_id for r in simhash.one_per_group(docs, width=5, similarity=0.8).collect()] == [0]


def test_squares_of_a_large_group(spark, edited):
    """A group that is cut into many blocks has the same links as one that is not."""
    rng = np.random.default_rng(12)
    base = [f"w{x}" for x in range(150)]
    rows = []
    for i in range(300):
        copy = list(base)
        for k in rng.choice(150, rng.integers(1, 10), replace=False):
            copy[k] = f"x{rng.integers(10**6)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "id long, text string")
    signed = cut_lineage(docs.select("id", "text", near._signed(5)(docs["text"].cast("binary")).alias("_s")).select("id", "text", "_s.*"))
    names = {r["class"]: r["id"] for r in signed.collect()}
    cells, texts = signed.select("class", "n", "cells"), signed.select("class", "text")
    found = []
    for block in (16, 10**6):
        label = {i: i for i, _ in rows}
        edges = [(names[r.a], names[r.b]) for r in near.links(texts.join(near.members(cells, block), "class"), 5, 0.8, block).collect()]
        for _ in rows:
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        found.append(sorted(set(label.values())))
    assert found[0] == found[1] == plain_kept(rows)


@pytest.mark.parametrize("texts", [[], [b""], [None, b"a B", b"", b"one two three four five six one two three four five six"]])
def test_shingles_of_short_texts(texts):
    h, first = near.shingles(words.block(texts), 5)
    assert [len(np.unique(h[a:b])) for a, b in zip(first[:-1], first[1:])] == [len(plain_set(t.decode())) if t and t.split() else 0 for t in texts]


def test_edge_cases(spark):
    long = "word" * 10 + " x" * 100_000
    rows = [(5, None), (3, ""), (4, " \t\n"), (9, long), (8, long), (8, long), (None, long), (None, "alone in this text"), (None, "alone in this text"), (2, "One two"), (1, "one  TWO")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.one_per_group(docs, width=5, similarity=0.8)
    assert got.columns == docs.columns and sorted((r.doc_id or -1 for r in got.collect())) == [-1, 1, 3, 8]
    assert simhash.one_per_group(docs.limit(0), width=5, similarity=0.8).count() == 0
    with pytest.raises(ValueError):
        simhash.one_per_group(docs, width=5)


def test_sides_beyond_a_broadcast(spark, sf):
    """The same rows when every measured side is too big, with null ids and repeated rows; no broadcast is asked for or chosen."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("doc_id < 120")
    more = docs.where("doc_id < 20").selectExpr("CAST(NULL AS bigint) AS doc_id", "concat(text, ' more') AS text")
    docs = cut_lineage(docs.union(more).union(more).union(docs.where("doc_id < 9")))
    forms = [lambda: simhash.one_per_group(docs, width=5, similarity=0.8), lambda: remove_repeats(docs, window=20)]
    want = [sorted(map(str, form().collect())) for form in forms]
    keep, auto = bounds.broadcast_if_small.__defaults__, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        bounds.broadcast_if_small.__defaults__ = (0, 0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert [sorted(map(str, form().collect())) for form in forms] == want
    finally:
        bounds.broadcast_if_small.__defaults__ = keep
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_fingerprints_are_majorities_of_shingle_hashes():
    texts = [b"a b c d e f g a b c d e f g", b"", b"one", None, b"x " * 300]
    h, first = near.shingles(words.block(texts), 5)
    for got, x, y in zip(near.fingerprints(h, first), first[:-1], first[1:]):
        assert int(got) == sum(1 << b for b in range(64) if 2 * sum(int(v) >> b & 1 for v in h[x:y]) > y - x)


def test_simhash_finds_candidates_of_the_stage(spark, sf, monkeypatch):
    """The named method takes part: without any MinHash cell, copies within 2 bits are still found and compared exactly."""
    base = [f"w{i}" for i in range(3000)]
    rows = [(1, " ".join(base)), (2, " ".join([*base[:-1], "end"])), (3, " ".join(f"v{i}" for i in range(50)))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    plain = near.members
    monkeypatch.setattr(near, "members", lambda rows, **k: plain(rows.withColumn("cells", F.array().cast("array<long>")), **k))
    assert sorted(r.doc_id for r in cp.near_duplicates(spark, docs, sf).collect()) == [1, 3]


def test_texts_of_repeated_windows_are_not_shuffled(spark):
    """While the texts that hold single repeated windows are few, their keys are broadcast; the texts of all documents stay where they are."""
    rng, seen = np.random.default_rng(5), []
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 10**6, 200))) for i in range(60)]
    rows += [(100 + i, " ".join([*rows[i][1].split()[40:160], *(f"u{x}" for x in rng.integers(0, 10**6, 30))])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept, plain = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), substrings.cut_lineage
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        with pytest.MonkeyPatch.context() as m:
            m.setattr(substrings, "cut_lineage", lambda df: (seen.append(df._jdf.queryExecution().sparkPlan().toString()), plain(df))[1])
            remove_repeats(docs).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    hashed = [p for p in seen if "h1" in p and "MapInArrow" in p]
    assert hashed and all("BroadcastHashJoin" in p and "SortMergeJoin" not in p for p in hashed)
