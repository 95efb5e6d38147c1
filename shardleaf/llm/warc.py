"""WARC 1.1 archives as a PySpark data source, read and written.

    spark.dataSource.register(WarcDataSource)
    spark.read.format("warc").load(folder).where("record_type = 'response' AND target_uri LIKE 'https://a.org/%'")

Reading plans one partition per piece of a file. Files that this source wrote come in pieces of about SPLIT
bytes that begin at a record, as their manifest says; of other folders every *.warc and *.warc.gz file is a
piece. The headers of a record are parsed first; predicates on record type and header columns are taken
over from Spark and decided on them, and the block of an unwanted record is skipped by a seek: not read, not
decoded. With the option payload=false no block is read at all.

Writing makes one file per task, in the folder of the option path, which every executor has to reach: any
store that pyarrow.fs opens. The manifest, written once all tasks are done, names the files that count,
so files of failed or repeated tasks are never read. Payloads are the gzip-encoded bodies of HTTP
responses; a revisit record has none.
"""

from __future__ import annotations

import gzip
import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import datasource as ds
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ..plans import broadcast_if_small, cut_lineage

SPLIT = 16 << 20
MANIFEST = "_manifest.json"
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
MIN_REVISIT = 100
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "content_type": "Content-Type",
    "payload_length": "X-Payload-Length", "content_length": "Content-Length",
}
LONGS = ("payload_length", "content_length")
SCHEMA = StructType([StructField(c, LongType() if c in LONGS else StringType()) for c in HEADERS] + [StructField("payload", BinaryType())])


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class _Bytes:
    """Buffered reading of a file with lines, skips and a position."""

    def __init__(self, file, seekable: bool) -> None:
        self.file, self.seekable, self.buf, self.at, self.base = file, seekable, b"", 0, file.tell() if seekable else 0

    @property
    def position(self) -> int:
        return self.base + self.at

    def _more(self, n: int = 1 << 16) -> bool:
        got = self.file.read(n)
        self.base, self.buf, self.at = self.base + self.at, self.buf[self.at :] + got, 0
        return bool(got)

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        seen = self.at
        while (end := self.buf.find(b"\n", seen)) < 0:
            seen = len(self.buf) - self.at
            if not self._more():
                rest, self.at = self.buf[self.at :], len(self.buf)
                return rest or None
        out, self.at = self.buf[self.at : end], end + 1
        return out.rstrip(b"\r")

    def skip_line_ends(self) -> None:
        while self.at < len(self.buf) or self._more():
            if self.buf[self.at] not in b"\r\n":
                return
            self.at += 1

    def read(self, n: int) -> bytes:
        while len(self.buf) - self.at < n and self._more(max(1 << 16, n - len(self.buf) + self.at)):
            pass
        out = self.buf[self.at : self.at + n]
        self.at += len(out)
        return out

    def skip(self, n: int) -> None:
        have = len(self.buf) - self.at
        if n <= have:
            self.at += n
        elif self.seekable:
            self.base, self.buf, self.at = self.position + n, b"", 0
            self.file.seek(self.base)
        else:
            while n > 0 and (got := len(self.read(min(n, 1 << 20)))):
                n -= got


def _headers(data: _Bytes) -> dict[str, str] | None:
    """Header fields, names in lower case, of the record that begins here; None at the end. Raises ValueError if none does."""
    if (line := data.line()) is None:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record at byte {data.position - len(line)}")
    fields, name = {}, None
    while line := data.line():
        if line[:1] in (b" ", b"\t") and name:  # folded
            fields[name] += " " + line.strip().decode("utf-8", "replace")
            continue
        key, _, value = line.partition(b":")
        name = key.strip().decode("utf-8", "replace").lower()
        fields[name] = value.strip().decode("utf-8", "replace")
    return fields


def _row(fields: dict[str, str]) -> dict:
    out = {c: fields.get(h.lower()) for c, h in HEADERS.items()}
    for c in LONGS:
        out[c] = int(out[c]) if out[c] and out[c].isdigit() else None
    return out


def _payload(row: dict, block: bytes) -> bytes | None:
    """The decoded body of an HTTP response, or the block of any other record; a revisit has none."""
    if row["record_type"] == "revisit":
        return None
    if not (row["content_type"] or "").lower().startswith("application/http"):
        return block
    head, _, body = block.partition(b"\r\n\r\n")
    fields = [x.lower().split(b":", 1) for x in head.split(b"\r\n")[1:]]
    coding = next((x[1].strip() for x in fields if len(x) == 2 and x[0].strip() == b"content-encoding"), b"")
    return zlib.decompress(body, 47) if coding in (b"gzip", b"deflate") else body


_TESTS: dict[type, Callable] = {
    ds.EqualTo: lambda v, f: v is not None and v == f.value, ds.In: lambda v, f: v is not None and v in f.value,
    ds.GreaterThan: lambda v, f: v is not None and v > f.value, ds.GreaterThanOrEqual: lambda v, f: v is not None and v >= f.value,
    ds.LessThan: lambda v, f: v is not None and v < f.value, ds.LessThanOrEqual: lambda v, f: v is not None and v <= f.value,
    ds.StringStartsWith: lambda v, f: v is not None and v.startswith(f.value), ds.StringContains: lambda v, f: v is not None and f.value in v,
    ds.IsNotNull: lambda v, f: v is not None, ds.IsNull: lambda v, f: v is None,
}


@dataclass
class Piece(ds.InputPartition):
    path: str
    start: int
    end: int  # -1: to the end of the file


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.payload = options["path"], str(options.get("payload", "true")).lower() != "false"
        self.wanted: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.wanted.append(f)
            else:
                yield f

    def partitions(self) -> list[Piece]:
        fs, root = _store(self.path)
        listed = fs.get_file_info(f"{root}/{MANIFEST}")
        if listed.type == pafs.FileType.File:
            with fs.open_input_stream(listed.path) as f:
                files = json.loads(f.read())
            return [Piece(f"{root}/{x['file']}", a, b) for x in files for a, b in zip(x["splits"], [*x["splits"][1:], -1])]
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
        return [Piece(x.path, 0, -1) for x in found if x.type == pafs.FileType.File and x.path.endswith((".warc", ".warc.gz"))]

    def read(self, partition: Piece | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark asks for where there is no piece at all
            return
        fs, _ = _store(self.path)
        schema = pa.schema([(c, pa.int64() if c in LONGS else pa.string()) for c in HEADERS] + [("payload", pa.binary())])
        rows, size = [], 0
        with fs.open_input_file(partition.path) as raw:
            packed = partition.path.endswith(".gz")
            raw.seek(partition.start)
            data = _Bytes(gzip.GzipFile(fileobj=raw) if packed else raw, not packed)
            while True:
                data.skip_line_ends()  # those that end the record before; a piece ends where the next record begins
                if 0 <= partition.end <= data.position:
                    break
                fields = _headers(data)
                if fields is None:
                    break
                row = _row(fields)
                length = row["content_length"] or 0
                if not all(_TESTS[type(f)](row[f.attribute[0]], f) for f in self.wanted):
                    data.skip(length)
                    continue
                if self.payload and row["record_type"] != "revisit":
                    row["payload"] = _payload(row, data.read(length))
                    size += len(row["payload"] or b"")
                else:
                    data.skip(length)
                    row["payload"] = None
                rows.append(row)
                if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


@dataclass
class Written(ds.WriterCommitMessage):
    file: str | None
    splits: list[int]


def _field(value: object) -> bytes:
    """A header value on one line."""
    text = str(value)
    for c in "\r\n":
        text = text.replace(c, f"%{ord(c):02X}")
    return text.encode()


def record_bytes(row: dict) -> bytes:
    """One record as it stands in a file; row: the columns of the source, those missing or null are left out."""
    payload, revisit = row.get("payload"), row.get("record_type") == "revisit"
    block, row = b"", dict(row)
    if not revisit:
        zipped = gzip.compress(payload or b"", 6, mtime=0)
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Encoding: gzip\r\n\r\n" + zipped
    row |= {"content_length": len(block), "content_type": row.get("content_type") or "application/http; msgtype=response", "date": row.get("date") or "1970-01-01T00:00:00Z"}
    lines = [VERSION, *(h.encode() + b": " + _field(row[c]) for c, h in HEADERS.items() if row.get(c) is not None)]
    if revisit:
        lines.append(b"WARC-Profile: " + REVISIT_PROFILE.encode())
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.overwrite = options["path"], overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _store(self.path)
        name, out, at, splits = f"part-{uuid.uuid4().hex}.warc", None, 0, [0]
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None:
                        fs.create_dir(root)
                        out = fs.open_output_stream(f"{root}/{name}")
                    if at - splits[-1] >= SPLIT:
                        splits.append(at)
                    record = record_bytes(row)
                    out.write(record)
                    at += len(record)
        finally:
            if out is not None:
                out.close()
        return Written(name if out else None, splits)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _store(self.path)
        fs.create_dir(root)
        files = [{"file": m.file, "splits": m.splits} for m in messages if m and m.file]
        old = fs.get_file_info(f"{root}/{MANIFEST}")
        if not self.overwrite and old.type == pafs.FileType.File:
            with fs.open_input_stream(old.path) as f:
                files = json.loads(f.read()) + files
        with fs.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write(json.dumps(files).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Files of finished tasks stay unlisted, so nothing reads them."""


class WarcDataSource(ds.DataSource):
    """Format "warc". Options: path (a folder), payload (false: headers only)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> StructType:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known and let Spark hand predicates to Python sources: the one session setting this module needs."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set(PUSHDOWN, "true")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Pages as records. Of equal payloads of min_bytes or more, the one with the smallest id is a response and the others
    revisit it; a page without id revisits if any with one is there. Rows with equal id and payload are of one type. A null
    payload is an empty one, a null URL has no header. Other columns are not read."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha2("payload", 256), "payload_length": F.octet_length("payload").cast("long")})
    many = rows.where(F.col("payload_length") >= min_bytes).groupBy("payload_digest").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    many = cut_lineage(many.where("_n > 1").select(F.col("payload_digest").alias("_digest"), "_first"))
    joined = rows.join(broadcast_if_small(many), F.col("payload_digest") == F.col("_digest"), "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    name = lambda c, other: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), other), F.lit(">"))
    unnamed = F.concat(F.lit("none-"), "payload_digest", F.lit("-"), F.hex(F.xxhash64("target_uri")))
    return joined.select(
        name("_id", unnamed).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.concat(F.lit("sha256:"), "payload_digest").alias("payload_digest"), F.when(revisit, name("_first", F.lit(""))).alias("refers_to"),
        "payload_length", F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_warc(rows: DataFrame, path: str) -> None:
    register(rows.sparkSession)
    rows.write.format("warc").option("path", path).mode("append").save()


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of archived pages: responses by decoding their
    payloads, revisits by their headers alone."""
    def page(c: str) -> Column:
        return F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")

    got = read_warc(spark, path).where("record_type = 'response'").select(
        page("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"),
    )
    again = read_warc(spark, path, payload=False).where("record_type = 'revisit'").select(
        page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"),
    )
    return got.unionByName(again)
