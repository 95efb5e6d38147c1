import hashlib

import duckdb
import numpy as np
import pytest

from shardleaf.llm.lines import PerfectHash, drop_repeated_lines
from shardleaf.llm.queries import QUERIES, SQL, table

SPACES = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACES))


def plain(rows, chars=10):
    """(id, lines, dropped, digest) per row, from a dictionary of lines."""
    ids = {}
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= chars:
                    ids.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or key(x) not in ids or min(ids[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def ours(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in df.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()), key=repr)


def test_query_equals_brute_force_and_sql(spark, sf):
    got = ours(QUERIES["op13_lines"](spark, sf))
    assert got == plain([(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()])
    assert sum(n for _, _, n, _ in got) > 0
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{sf}/documents.parquet'")
    assert sorted(con.sql("SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM (" + SQL["op13_lines"] + ")").fetchall(), key=repr) == got


CASES = [
    (3, "A shared line here\nown line number three\nshort"), (1, "  a SHARED line HERE \t\r\nshort\n"), (2, "a shared line here"), (2, "A SHARED LINE HERE\nonly in two, twice\nonly in two, twice"),
    (4, "exactly10c\nnine char\nÉÉÉÉÉÉÉÉÉÉ\nééééééééé"), (5, "EXACTLY10C\nNINE CHAR\nÉÉÉÉÉÉÉÉÉÉ\nééééééééé"), (6, "éééééééééé\n日本語日本語日本語日"), (7, "日本語日本語日本語日\néééééééééé"),
    (8, None), (9, ""), (10, "\n\n\n"), (None, "a shared line here"), (None, "null ids have no say"), (11, "null ids have no say"), (12, " wide space at the end "),
    (13, "wide space at the end"), (14, "vertical\x0btab inside x"), (15, "\x0bvertical\x0btab inside x\x0c"), (-1, "only in two, twice"), (16, "a shared line here"), (16, "a shared line here"),
    (17, "carriage\rreturn inside"), (18, "NUL \x00 in a long line"), (19, "NUL \x00 in a long line"), (2**62, "short\nA shared line here\nshort"),
]


@pytest.mark.parametrize("shard_lines", [1, 3, 1 << 17])
def test_cases(spark, shard_lines):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in CASES], "doc_id long, text string, n_lines int, key_ string, kept_ int").repartition(5)
    got = drop_repeated_lines(docs, shard_lines=shard_lines)
    assert got.columns == ["doc_id", "text", "n_lines", "key_", "kept_", "n_dropped", "kept_sha256"]
    assert ours(got) == plain(CASES)
    texts = {r.doc_id: (r.text, r.key_, r.kept_) for r in got.collect()}
    assert texts[3] == ("own line number three\nshort", "x", 2) and texts[8][0] is None and texts[9][0] == ""
    assert texts[1][0] == CASES[1][1] and texts[2**62][0] == "short\nshort"


def test_other_length(spark):
    docs = spark.createDataFrame(CASES, "doc_id long, text string")
    assert ours(drop_repeated_lines(docs, chars=5)) == plain(CASES, 5)


def test_hot_line_over_partitions_and_long_text(spark):
    rows = [(i, f"the same line everywhere\nline of {i % 7} here\nand {i}") for i in range(3000)]
    rows.append((5000, "\n".join(f"long text, line {i % 90_000}" for i in range(200_000)) + "\nthe same line everywhere"))
    rows.append((5001, "\n".join(f"long text, line {i}" for i in range(50_000, 60_000))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    assert ours(drop_repeated_lines(docs, shard_lines=1000)) == plain(rows)


def test_empty_tables(spark):
    assert drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert ours(drop_repeated_lines(spark.createDataFrame([(1, None), (None, None)], "doc_id long, text string"))) == plain([(1, None), (None, None)])


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 131_072])
def test_perfect_hash_numbers_each_key_once(n):
    draw = np.random.default_rng(n)
    h1, h2 = draw.integers(0, 1 << 64, n, np.uint64), draw.integers(0, 1 << 64, n, np.uint64)
    h1[: n // 2] = 7  # keys that differ in one half only
    hashed = PerfectHash.build(h1, h2)
    again = PerfectHash(hashed.sizes, hashed.packed.tobytes())
    assert sorted(again.numbers(h1, h2)) == list(range(n))
    assert len(hashed.packed) * 8 <= 4.5 * n + 64 if n else not len(hashed.packed)
