import gzip
import hashlib

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from shardleaf.llm import warc
from shardleaf.plans import shared_dir

HTML = "<p>" + "x" * 200 + "é</p>"


@pytest.fixture(scope="module")
def archive(spark):
    rows = [
        (3, "https://a.org/3", HTML), (1, "https://a.org/1", HTML), (2, "https://b.org/2", "short"), (4, "https://b.org/4", "short"), (5, None, None),
        (None, "https://c.org/\r\nX-Evil: 1", HTML), (6, "https://c.org/6", "other " * 50), (1, "https://a.org/1", HTML), (7, "https://c.org/7", "y" * 2_000_000), (-8, "https://c.org/8", "z" * 100),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string")
    path = shared_dir(spark, "warc-test")
    warc.write_warc(warc.records(pages).repartition(3), path)
    return path, rows


def test_round_trip(spark, archive):
    path, rows = archive
    got = sorted((tuple(r) for r in warc.read_pages(spark, path).collect()), key=repr)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = 1 if html == HTML else i
        again = len(data) >= 100 and i != first
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=repr)


def test_records_follow_the_format(spark, archive):
    path, _ = archive
    fs, root = warc._store(path)
    files = [f.path for f in fs.get_file_info(pafs.FileSelector(root)) if f.path.endswith(".warc")]
    data = b"".join(open(f, "rb").read() for f in files)
    heads = [x.split(b"\r\n\r\n")[0] for x in data.split(b"WARC/1.1\r\n")[1:]]
    assert len(heads) == 10 and data.endswith(b"\r\n\r\n")
    assert all(b"WARC-Record-ID: <urn:page:" in h and b"Content-Length: " in h and b"WARC-Date: " in h for h in heads)
    assert not any(line.startswith(b"X-Evil") for line in data.split(b"\r\n"))


def test_predicates_are_taken_over_and_skip_blocks(spark, archive, monkeypatch):
    path, _ = archive
    wanted = warc.read_warc(spark, path).where("record_type = 'response' AND target_uri LIKE 'https://b.org/%' AND payload_length < 100 AND payload_length IS NOT NULL")
    assert wanted.count() == 2
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0], "Spark is left no predicate to evaluate"
    reader = warc.WarcReader({"path": path})
    from pyspark.sql import datasource as ds

    kept = list(reader.pushFilters([ds.EqualTo(("record_type",), "revisit"), ds.EqualTo(("payload",), b""), ds.Not(ds.IsNull(("date",)))]))
    assert len(kept) == 2
    monkeypatch.setattr(warc, "_payload", lambda *a: pytest.fail("a block was decoded"))
    monkeypatch.setattr(warc._Bytes, "read", lambda self, n: pytest.fail("a block was read"))
    found = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert len(found) == 2 and {r["record_type"] for r in found} == {"revisit"}


def test_headers_only(spark, archive):
    path, _ = archive
    rows = warc.read_warc(spark, path, payload=False)
    assert rows.count() == 10 and rows.where(F.col("payload").isNotNull()).count() == 0


def test_foreign_archives(spark, tmp_path):
    """Records of other tools: per-record gzip, folded headers, plain blocks, identity coding, no manifest."""
    def record(kind, block, extra=b""):
        return b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nwarc-record-id: <urn:x:1>\r\n" + extra + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"

    info = record(b"warcinfo", b"software: loom\r\n")
    body = record(b"response", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nWARC/1.0 inside\r\n\r\n", b"Content-Type: application/http;\r\n  msgtype=response\r\nWARC-Target-URI: http://x/\r\n")
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(body))
    (tmp_path / "b.warc").write_bytes(info + body)
    (tmp_path / "notes.txt").write_bytes(b"no archive")
    got = warc.read_warc(spark, f"file://{tmp_path}").orderBy("record_type").collect()
    assert [r.payload for r in got] == [b"WARC/1.0 inside\r\n\r\n"] * 2 + [b"software: loom\r\n"] * 2
    assert got[0].content_type == "application/http; msgtype=response"
    assert warc.read_warc(spark, f"file://{tmp_path}").where("target_uri = 'http://x/'").count() == 2


def test_pieces_begin_at_records(spark, archive, monkeypatch):
    path, _ = archive
    fs, root = warc._store(path)
    reader = warc.WarcReader({"path": path})
    assert all(p.start < (p.end if p.end >= 0 else 1 << 62) for p in reader.partitions())
    monkeypatch.setattr(warc, "SPLIT", 1)
    writer = warc.WarcWriter({"path": f"{root}-split"}, False)
    import pyarrow as pa

    rows = [{"record_id": f"<urn:page:{i}>", "record_type": "response", "payload": b"p" * i} for i in range(20)]
    writer.commit([writer.write(iter([pa.RecordBatch.from_pylist(rows[:12]), pa.RecordBatch.from_pylist(rows[12:])]))])
    again = warc.WarcReader({"path": f"{root}-split"})
    pieces = again.partitions()
    assert len(pieces) == 20
    assert [r["payload"] for p in pieces for b in again.read(p) for r in b.to_pylist()] == [r["payload"] for r in rows]


def test_empty_table(spark):
    path = shared_dir(spark, "warc-empty")
    warc.write_warc(warc.records(spark.createDataFrame([], "page_id long, url string, html string")), path)
    assert warc.read_pages(spark, path).count() == 0
