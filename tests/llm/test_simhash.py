import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from shardleaf.llm import simhash
from shardleaf.llm.components import components
from shardleaf.llm.queries import QUERIES, table

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def plain_groups(fps, bits=2):
    """Smallest index reachable over links, for a list of fingerprints."""
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    a = np.array(fps, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= bits):
            x, y = find(i), find(int(j))
            label[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def test_query_equals_brute_force(spark, sf):
    docs = sorted((r.doc_id, r.text) for r in table(spark, sf, "documents").collect())
    fps = [plain_fingerprint(t) for _, t in docs]
    roots = plain_groups(fps)
    want = [(d, f"{fp:016x}", docs[r][0]) for (d, _), fp, r in zip(docs, fps, roots)]
    assert sorted(tuple(r) for r in QUERIES["op1_simhash"](spark, sf).collect()) == want
    assert len(set(roots)) < len(docs), "the data should hold near-duplicates"


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB É\t\n\x0b  ß", max_size=60))
def test_fingerprint_of_any_text(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_links_around_one_fingerprint(spark):
    """Distances 0 to 4 from one fingerprint, chains, and a dense ball: linked exactly up to 2 bits."""
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 2**63))
    fps = {centre, 0, (1 << 64) - 1, 1 << 63, (1 << 63) | 1}
    for bits in (1, 2, 3, 4):
        for _ in range(40):
            fps.add(centre ^ int(np.bitwise_or.reduce([np.uint64(1 << int(b)) for b in rng.choice(64, bits, replace=False)])))
    chain = int(rng.integers(0, 2**63))
    for b in range(0, 60, 2):
        fps.add(chain := chain ^ (3 << b))
    fps |= {int(x) for x in rng.integers(0, 2**63, 200)}
    fps = sorted(fps)
    signed = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    edges = simhash.link_stars(spark.createDataFrame(signed, "fp long"))
    roots = {r.node: r.root for r in components(edges).collect()}
    ours = [roots.get(s[0], s[0]) for s in signed]
    theirs = plain_groups(fps)
    pairs = {(a, b) for a, b in zip(ours, theirs)}
    assert len(pairs) == len(set(ours)) == len(set(theirs))


def test_edge_cases(spark):
    long = "word" * 10 + " x" * 200_000
    rows = [(5, None, 1), (3, "", 1), (4, " \t\n", 1), (9, long, 2), (8, long, 2), (8, long, 2), (None, long, 2), (None, "alone in this text", 3), (2, "One two", 4), (1, "one  TWO", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int").withColumnRenamed("fingerprint", "component_id")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.simhash_groups(docs).collect()), key=repr)
    assert got == sorted([(5, 3), (3, 3), (4, 3), (9, 8), (8, 8), (8, 8), (None, 8), (None, None), (2, 1), (1, 1)], key=repr)
    kept = sorted((r.doc_id or -1 for r in simhash.one_per_group(docs).collect()))
    assert kept == [-1, 1, 3, 8]
    assert simhash.one_per_group(docs).columns == docs.columns


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(docs).count() == 0 and simhash.one_per_group(docs).count() == 0


@pytest.mark.parametrize("edges, want", [
    ([], {}),
    ([(1, 1), (None, 2)], {}),
    ([(5, 4), (4, 3), (3, 9), (20, 21), (5, 4)], {3: 3, 4: 3, 5: 3, 9: 3, 20: 20, 21: 20}),
    ([(i, i + 1) for i in range(200)], {i: 0 for i in range(201)}),
    ([(500, i) for i in range(100)], {i: 0 for i in [*range(100), 500]}),
    ([(i, (i * 7919) % 101) for i in range(101)] , None),
])
def test_components(spark, edges, want):
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    if want is None:
        label = {x: x for e in edges for x in e}
        for _ in label:
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        want = {x: r for x, r in label.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert got == want
