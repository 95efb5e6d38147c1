import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from shardleaf.llm import merkle
from shardleaf.llm.merkle import manifest
from shardleaf.llm.queries import QUERIES, SQL, UPPER, table

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes, fanout=16):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def path(levels, at, fanout=16):
    out = []
    for level in levels[:-1]:
        lo = at - at % fanout
        out.append((level[lo:at], level[at + 1 : lo + fanout]))
        at //= fanout
    return out


def plain(rows):
    """The contract, from whole trees. rows: doc_id, source, lang, n_chars, text."""
    per = {}
    for r in rows:
        per.setdefault(r[1], []).append(r)
    sources = sorted(per, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(per[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    levels = {s: tree([leaf(r) for r in trees[s]]) for s in sources}
    top = tree([levels[s][-1][0] for s in sources])
    out = []
    for j, s in enumerate(sources):
        for i, r in enumerate(trees[s]):
            steps = path(levels[s], i) + path(top, j)
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                node = leaf((*r[:4], r[4].translate(str.maketrans(UPPER, UPPER.lower()))))
            for left, right in steps:
                node = h(*left, node, *right)
            root = top[-1][0]
            out.append((r[0], leaf(r), levels[s][-1][0], root, h(*[x for a, b in steps for x in a + b]), node, node == root))
    return sorted(out, key=repr)


def ours(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def query(docs, levels=merkle.LEVELS):
    lowered = {"text": F.translate("text", UPPER, UPPER.lower())}
    return manifest(docs, claimed=lowered, where=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, levels=levels)


def test_query_equals_brute_force_and_sql(spark, sf):
    got = ours(QUERIES["op12_merkle"](spark, sf))
    assert got == plain([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in table(spark, sf, "documents").collect()])
    assert {r[-1] for r in got} == {True, False}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{sf}/documents.parquet'")
    assert ours(spark.createDataFrame(con.sql(SQL["op12_merkle"]).df())) == got


@pytest.mark.parametrize("levels", [1, 2, 3])
@pytest.mark.parametrize("sizes", [(1,), (16,), (17,), (1, 1), (256, 257, 1, 15), (300, 4097, 2)])
def test_sizes(spark, sizes, levels):
    """Trees of just one run, one more, one superblock, one more, over superblocks of 16, 256 and 4096 leaves."""
    if sum(sizes) > 4000 and levels == 1:
        sizes = (300, 2)
    rows = [(1000 * s + i, f"s{s}", None, i, f"Text {i}") for s, n in enumerate(sizes) for i in range(n)]
    assert ours(query(spark.createDataFrame(rows, SCHEMA), levels)) == plain(rows)


def test_nulls_ties_clashes_many_sources(spark):
    rows = [(None, None, None, None, None), (None, None, "x", 1, "A"), (2**60 + 1, None, "", 0, ""), (5, "", "é", -3, "É ß \n" * 30), (5, "", "é", -3, "Other")]
    rows += [(7, "b", "l", 1, "Same")] * 20 + [(i, f"source {i}", "l", i, "T") for i in range(40)] + [(9, "-", "l", 1, "T"), (9, "=", "l", 1, "T"), (1, "é", "", 2, "T")]
    docs = spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA + ", tree string, root string, pos int")
    assert ours(query(docs)) == plain(rows)


def test_other_tampering_is_found(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("text").alias("text"))
    cols = ("doc_id", "text")
    assert manifest(docs, cols=cols).where("verified").count() == 100
    moved = manifest(docs, cols=cols, claimed={"doc_id": F.col("doc_id") + 1}, where=F.col("doc_id") == 3)
    assert [r.doc_id for r in moved.where("NOT verified").collect()] == [3]


def test_long_text_and_empty_table(spark):
    rows = [(1, "s", "l", 1, "Word " * 400_000), (2, "s", "l", 1, "")]
    assert ours(query(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    assert query(spark.createDataFrame([], SCHEMA)).count() == 0
