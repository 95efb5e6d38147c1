import itertools

import numpy as np
import pytest

from shardleaf.llm import lattice
from shardleaf.llm.queries import QUERIES, table


def is_e8(points):
    twice = np.rint(points * 2)
    whole = (twice % 2 == 0).all(1) | (twice % 2 == 1).all(1)
    return np.allclose(twice, points * 2) and whole.all() and (points.sum(1) % 2 == 0).all()


def test_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)) * 1.5
    z = lattice.nearest_e8(x)
    assert is_e8(z)
    d = ((x - z) ** 2).sum(1)
    for v in lattice.roots().T:  # a point whose distance no minimal vector lessens is the nearest one
        assert (((x - z - v) ** 2).sum(1) >= d - 1e-9).all()
    assert d.max() <= 1 + 1e-9, "the covering radius of the lattice is 1"


def test_roots():
    r = lattice.roots().T
    assert len({tuple(v) for v in r}) == 240 and is_e8(r) and ((r**2).sum(1) == 2).all()


def brute(ids, vectors, cosine=0.9):
    units = [lattice.unit(v) for v in vectors]
    near = lambda a, b: a is not None and b is not None and len(a) == len(b) and a @ b >= cosine
    links = [sum(i != j and near(units[i], units[j]) for j in range(len(ids))) for i in range(len(ids))]
    label = list(range(len(ids)))
    for _ in label:
        for i, j in itertools.combinations(range(len(ids)), 2):
            if near(units[i], units[j]):
                label[i] = label[j] = min(label[i], label[j])
    return links, label


def test_recall_at_the_threshold(spark):
    """Pairs at a cosine of barely 0.9, in several dimensions: at least nine in ten are found, none below it links."""
    rng = np.random.default_rng(7)
    for dim in (16, 64, 200):
        x = rng.normal(size=(300, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = rng.normal(size=x.shape)
        y -= (y * x).sum(1, keepdims=True) * x
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        cos = np.where(np.arange(300) < 200, 0.901, 0.899)[:, None]
        z = cos * x + np.sqrt(1 - cos**2) * y
        rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, z * 3]))]
        got = {r.vec_id: r for r in lattice.embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
        found = sum(got[300 + i].component_id == i for i in range(200))
        assert found >= 180, (dim, found)
        if dim > 16:
            assert all(got[300 + i].n_links == 0 for i in range(200, 300))


def test_query_equals_brute_force(spark, sf):
    data = table(spark, sf, "embeddings").orderBy("vec_id").collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in QUERIES["op10_lattice"](spark, sf).collect()}
    units = np.array([lattice.unit(r.embedding) for r in data])
    links = (units @ units.T >= 0.9).sum(1) - 1
    assert [got[r.vec_id][0] for r in data] == links.tolist()


@pytest.mark.parametrize("block", [512, 7])
def test_dense_groups_in_squares(spark, block):
    """A tight group larger than a block, with copies: every link counted once, however a cell is cut."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=24)
    vectors = [(centre + rng.normal(size=24) * s).round(3).tolist() for s in rng.choice([0.15, 0.3, 0.45], 70)]
    vectors += vectors[:9] + vectors[:3]
    ids = rng.permutation(len(vectors)).tolist()
    frame = spark.createDataFrame([*zip(ids, vectors)], "vec_id long, embedding array<double>")
    old = lattice.near_links.__defaults__
    lattice.near_links.__defaults__ = (old[0], block)
    try:
        got = {r.vec_id: r for r in lattice.embedding_groups(frame).collect()}
    finally:
        lattice.near_links.__defaults__ = old
    links, label = brute(ids, vectors)
    want, have = sum(links), sum(got[i].n_links for i in ids)
    assert 0.95 * want <= have <= want and all(got[i].n_links <= n for i, n in zip(ids, links))
    big = max(set(label), key=label.count)
    members = {i for i, x in zip(ids, label) if x == big}
    assert all(got[i].component_id == min(members) for i in members if got[i].n_links) and got[min(members)].kept


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, nan, 0.0]), (8, [inf, 0.0, 0.0]),
        (9, [1.0, None, 0.0]), (10, [1e300, 1e300, 0.0]), (11, [1e-300, 1e-300, 0.0]), (None, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (12, None), (13, [-1.0, 0.0, 0.0]),
    ]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, kept int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.embedding_groups(frame).collect()), key=repr)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 12, 13)]
    assert got == sorted([*alone, (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (None, 3, 1, False), (10, 1, 10, True), (11, 1, 10, False)], key=repr)
    assert lattice.embedding_groups(frame.limit(0)).count() == 0
