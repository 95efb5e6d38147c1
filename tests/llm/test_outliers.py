"""Robust outliers where copies of one text hold a large part of a cell."""

import numpy as np
import pytest

from shardleaf.llm import outliers


@pytest.mark.parametrize("far", [[5, 4, -2, 3, 3], [2.6, 2.5, 0.9, 1.5, 1.2]])
def test_mcd_stands_a_third_of_copies(spark, far):
    """2000 texts of a clean cloud and 1000 copies of one far text: every copy is out, the clean ones stay."""
    rng = np.random.default_rng(4)
    x = rng.multivariate_normal([1.6, 0.5, 0.9, 0.3, 0.2], 0.02 * np.eye(5) + 0.01, 2000)
    rows = [(1, *map(float, r)) for r in np.concatenate([x, np.tile(far, (1000, 1))])]
    fit = outliers.fit_mcd(spark.createDataFrame(rows, ["cell", *outliers.NAMES])).first()
    d = lambda p: np.einsum("ij,jk,ik->i", p - fit.centre, np.reshape(fit.inverse, (5, 5)), p - fit.centre)
    cut = outliers.chi2_quantile(1 - outliers.TAIL, 5)
    assert d(np.array([far]))[0] > cut and (d(x) <= cut).mean() > 0.998
    assert np.allclose(fit.centre, x.mean(0), atol=0.05)


def test_copies_of_a_junk_text_are_not_kept(spark):
    """A third of one language and source is copies of a text that passes the base rules."""
    rng = np.random.default_rng(6)
    text = lambda: " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(80))
    junk = " ".join(f"{w}$$ #{w.upper()}" for w in text().split()[:40])
    rows = [(i, text(), "en", "s") for i in range(200)] + [(1000 + i, junk, "en", "s") for i in range(100)]
    got = outliers.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert not any(r.base_failed for r in got)
    assert {r.doc_id for r in got if not r.kept} >= {1000 + i for i in range(100)}
    assert sum(r.kept for r in got if r.doc_id < 1000) >= 196
