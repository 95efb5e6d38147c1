"""Toxicity, quality, outliers: fits against plain forms, held-out accuracy, edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardleaf.llm import outliers, quality, toxicity, words
from shardleaf.llm.queries import QUERIES, severity_grade, table
from shardleaf.llm.stats import base_statistics

BIG = "/root/testdata/sf0.01"


def test_ordinal_gradient_reaches_the_optimum():
    """The likelihood at the fit is no worse than around it, thresholds ascend, weights have the right sign."""
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(3) < 0.5) for _ in range(600)]
    score = np.array([2.0 * (0 in r) - 1.0 * (1 in r) for r in rows]) + rng.logistic(size=600)
    grades = np.digitize(score, [0.5, 2.0])
    w, t = toxicity.fit_ordinal(rows, grades, 3, l2=0.0, steps=1500)

    def loss(w, t):
        s = np.array([w[r].sum() for r in rows])
        cdf = np.concatenate([np.zeros((600, 1)), 1 / (1 + np.exp(s[:, None] - t)), np.ones((600, 1))], 1)
        return -np.log(cdf[np.arange(600), grades + 1] - cdf[np.arange(600), grades]).mean()

    best = loss(w, t)
    assert t[0] < t[1] and w[0] > 1.2 and w[1] < -0.4 and abs(w[2]) < 0.5
    for k in range(3):
        for d in (-0.05, 0.05):
            assert loss(w + d * np.eye(3)[k], t) > best
    for k in range(2):
        for d in (-0.05, 0.05):
            assert loss(w, t + d * np.eye(2)[k]) > best


def test_severity_is_the_expected_grade():
    model = toxicity.OrdinalModel(np.zeros(0, np.uint64), np.zeros(0), np.array([0.0, 1.0]))
    above = model.above(np.array([0.5]))[0]
    p = [1 - above[0], above[0] - above[1], above[1]]
    assert sum(k * x for k, x in enumerate(p)) == pytest.approx(above.sum()) and sum(p) == pytest.approx(1)


def test_toxic_documents_are_told_apart(spark):
    """Learned on ids not divisible by 3, judged on the others."""
    docs, labels = table(spark, BIG, "documents"), table(spark, BIG, "labels")
    model = toxicity.fit_toxicity(docs, labels.where("doc_id % 3 != 0"), severity_grade())
    judged = toxicity.score_toxicity(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    clean, toxic = judged[judged.toxic == 0], judged[judged.toxic == 1]
    assert len(toxic) > 8 and clean.rejected.mean() < 0.02
    assert toxic.p_toxic.mean() > 2 * clean.p_toxic.mean()


def test_toxicity_edge_cases(spark):
    rows = [(i, ("vile " if i % 2 else "kind ") + f"text number{i % 7}", 5) for i in range(60)] + [(None, None, 5), (100, "", 5), (101, "vile " * 90_000, 5), (101, "vile " * 90_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, severity int")
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(60)] + [(3, 1, 1), (None, 1, 1), (7, None, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.fit_toxicity(docs, labels, severity_grade())
    got = toxicity.score_toxicity(docs, model)
    assert got.columns == ["doc_id", "text", "severity", "p_toxic", "grade", "rejected"]
    by = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(rows) and by[1].rejected and not by[2].rejected and by[101].rejected and by[None].p_toxic == by[100].p_toxic
    for data in ([], [(1, 0, 1)], [(1, 1, 1), (3, 1, 0)]):
        few = toxicity.fit_toxicity(docs, spark.createDataFrame(data, "doc_id long, toxic int, quality int"), severity_grade())
        scored = toxicity.score_toxicity(docs, few).collect()
        assert {r.rejected for r in scored} <= ({False} if not data or data[0][1] == 0 else {True, False})
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_quality_held_out_accuracy(spark):
    got = QUERIES["op4_quality"](spark, BIG).join(table(spark, BIG, "labels"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()


def test_additive_model_finds_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_additive(x, y)
    fresh = rng.random((1000, 3))
    assert (0, 1) in model.pairs and (model.score(fresh).round() == ((fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5))).mean() > 0.93


def test_score_is_a_sum_of_table_entries():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4))
    model = quality.fit_additive(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float))
    row = x[7]
    total = model.intercept
    for f, table_ in enumerate(model.tables):
        total += table_[sum(e <= row[f] for e in model.edges[f])]
    for (a, b), grid in zip(model.pairs, model.grids):
        total += grid[sum(e <= row[a] for e in model.coarse[a]), sum(e <= row[b] for e in model.coarse[b])]
    assert model.score(x)[7] == pytest.approx(1 / (1 + math.exp(-total)))


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "x " * 200_000, "c"), (3, "fine words here", "d"), (3, "fine words here", "d")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels, F.col("quality"))
    got = quality.score_quality(docs, model).toPandas()
    assert len(got) == 5 and (got.score == 0.5).all() and (got.predicted == 0).all()
    one = quality.fit_quality(docs, spark.createDataFrame([(3, 1)], "doc_id long, quality int"), F.col("quality"))
    assert (quality.score_quality(docs, one).toPandas().score > 0.5).all()
    assert quality.score_quality(docs.limit(0), model).count() == 0


def plain_counts(text):
    import re

    w = re.findall("[^\x20\x09-\x0D]+", text)
    seen, dup, windows, cover = set(), 0, {}, set()
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    for at in windows.values():
        if len(at) > 1:
            cover.update(j for i in at for j in range(i, i + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover)


def test_counts_equal_brute_force(spark, sf):
    texts = [r.text for r in table(spark, sf, "documents").collect()]
    texts += ["", " \n\t", "a\na\r\na\n\na", "é#😀\x0b<x>\n", "a b c d e f g h " * 3, "one two three four five six seven eight\n" * 2 + "x", "\n".join(["same line here"] * 9)]
    for part in (texts, texts[::-1], [""], []):
        got = base_statistics([t.encode() for t in part])
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        assert [tuple(int(got[c][i]) for c in names) for i in range(len(part))] == [plain_counts(t) for t in part]


def test_blocks_do_not_change_hashes():
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 50, rng.integers(0, 400))).encode() for _ in range(60)]
    whole = words.block(texts)
    alone = [words.block([t]) for t in texts]
    assert (whole.hashes() == np.concatenate([b.hashes() for b in alone])).all()
    tokens = whole.hashes()[:300]
    for width in (1, 2, 26, 50):
        h = words.window_hashes(tokens, width)
        assert len(h) == 300 - width + 1
        for i, j in rng.integers(0, len(h), (200, 2)):
            assert (h[i] == h[j]) == (tokens[i : i + width] == tokens[j : j + width]).all()


def test_mcd_ignores_planted_outliers(spark):
    """Estimates of a clean cloud with a fifth of far points equal those of the clean cloud alone; the far ones are out."""
    rng = np.random.default_rng(4)
    x = rng.multivariate_normal(np.zeros(5), 0.2 * np.eye(5) + 0.1, 2000) + [1.6, 0.5, 0.9, 0.3, 0.2]
    far = rng.normal(size=(500, 5)) * 0.05 + [5, 4, -2, 3, 3]
    def frame(a):
        return spark.createDataFrame([(1, *map(float, r)) for r in a], ["cell", *outliers.NAMES])
    both, alone = (outliers.fit_mcd(frame(a)).first() for a in (np.concatenate([x, far]), x))
    assert np.allclose(both.centre, alone.centre, atol=0.06) and np.allclose(both.centre, x.mean(0), atol=0.06)
    cov = np.linalg.inv(np.reshape(both.inverse, (5, 5)))
    assert np.allclose(cov, np.cov(x.T) + np.diag(np.array([*outliers.FLOORS.values()]) ** 2), atol=0.05)
    d = lambda p: np.einsum("ij,jk,ik->i", p - both.centre, np.reshape(both.inverse, (5, 5)), p - both.centre)
    cut = outliers.chi2_quantile(1 - 1e-6, 5)
    assert (d(far) > cut).all() and (d(x) <= cut).mean() > 0.998


@pytest.mark.parametrize("p, d, want", [(0.95, 5, 11.07), (0.75, 5, 6.626), (0.999, 3, 16.27)])
def test_chi_square_quantiles(p, d, want):
    assert outliers.chi2_quantile(p, d) == pytest.approx(want, rel=0.02)


def test_outliers_keep_clean_and_drop_junk(spark):
    rows = QUERIES["op7_outliers"](spark, BIG).join(table(spark, BIG, "labels"), "doc_id").toPandas()
    passed = rows[~rows.base_failed]
    assert passed[passed.quality == 1].kept.mean() > 0.99 and passed[passed.quality == 0].kept.mean() < 0.1
    assert (rows.base_failed == ((rows.n_words < 20) | (100 * rows.n_repeat_words > 30 * rows.n_words))).all() and not rows[rows.base_failed].kept.any()


def test_outlier_edge_cases(spark):
    body = "some plain words of a text that says this and that about one thing and another without end or aim"
    rows = [(i, f"{body} {i} more", "en" if i % 2 else None, "s", 1) for i in range(130)] + [
        (None, None, None, None, 1), (200, "", "en", None, 1), (201, "# $ % " * 60_000, "en", "s", 1), (1, f"{body} 1 more", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    got = outliers.quality_rules(docs).toPandas()
    assert len(got) == len(rows) and got[got.doc_id < 130].kept.all() and not got[got.doc_id >= 200].kept.any() and not got[got.doc_id.isna()].kept.any()
    assert outliers.quality_rules(docs.limit(0)).count() == 0
    assert not outliers.quality_rules(docs.where("doc_id = 200")).first()["kept"]
