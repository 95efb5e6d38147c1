import math
import re
from collections import Counter

import pytest

from shardleaf.llm import backoff
from shardleaf.llm.queries import QUERIES, table

WORD = re.compile(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+")


def plain(rows, least=2):
    """(id, words, score) by counting words and pairs in dictionaries."""
    split = [(i, [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")]) for i, t in rows]
    one = Counter(w for _, ws in split for w in ws)
    two = Counter(p for _, ws in split for p in zip(ws, ws[1:]))
    total, out = sum(one.values()), {}
    for i, ws in split:
        score = math.log(one[ws[0]] / total) if ws else 0.0
        for a, b in zip(ws, ws[1:]):
            score += math.log(two[a, b] / one[a]) if two[a, b] >= least else math.log(0.4 * one[b] / total)
        n, s = out.get(i, (0, 0.0))
        out[i] = (n + len(ws), s + score)
    return out


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    want = plain(rows)
    got = {r.doc_id: r for r in QUERIES["op6_backoff"](spark, sf).collect()}
    assert set(got) == set(want)
    for i, (n, score) in want.items():
        assert got[i].n_words == n and got[i].log_score == pytest.approx(score, rel=1e-5, abs=1e-4)
        assert got[i].perplexity == pytest.approx(math.exp(-score / n), rel=1e-4)


@pytest.mark.parametrize("vocabulary", [1, 40, 1000])
def test_rare_words_keep_their_counts(spark, sf, vocabulary):
    """The scores do not depend on how many words have a number."""
    docs = table(spark, sf, "documents")
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r.log_score for r in backoff.backoff_scores(docs, vocabulary=vocabulary).collect()}
    assert got == pytest.approx({i: s for i, (_, s) in want.items()}, rel=1e-6, abs=1e-6)


@pytest.mark.parametrize("vocabulary", [0, 1, 2, 3, 9])
@pytest.mark.parametrize("least", [1, 2, 3])
def test_pairs_of_rare_words(spark, vocabulary, least):
    """Rare before rare, before and after words with a number, a word after itself, parts of one document."""
    rows = [(1, "a a a a b b b c d"), (2, "a b c e c d d d"), (3, "c d c d e"), (3, "e a e a d d"), (4, "c"), (5, "b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.log_score for r in backoff.backoff_scores(docs, vocabulary=vocabulary, min_count=least).collect()}
    assert got == pytest.approx({i: s for i, (_, s) in plain(rows, least).items()}, rel=1e-9)


def test_edge_cases(spark):
    rows = [(5, None, 1), (6, "", 1), (7, "  ?! ", 1), (None, "one two one two", 1), (8, "one two", 1), (8, "Two, ONE two", 1), (2**40, "one two", 1), (9, "w " * 150_000, 1), (9, "w " * 150_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = {r.doc_id: r for r in backoff.backoff_scores(docs).collect()}
    want = plain(rows := [r[:2] for r in rows])
    assert set(got) == {5, 6, 7, 8, 9, 2**40, None} and got[None].log_score is None
    for i in (8, 9, 2**40):
        assert got[i].n_words == want[i][0] and got[i].log_score == pytest.approx(want[i][1], rel=1e-5)
    assert [got[i].log_score for i in (5, 6, 7)] == [0, 0, 0] and got[5].perplexity is None
    assert backoff.backoff_scores(docs.limit(0)).count() == 0
