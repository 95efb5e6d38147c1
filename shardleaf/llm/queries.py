"""Each operator of this subpackage as a query over a whole given table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans import shared_dir

from .alignment import align_tokens
from .backoff import backoff_scores
from .lattice import embedding_groups
from .lines import drop_repeated_lines
from .merkle import manifest
from .mixing import mix, taken_words
from .outliers import quality_rules
from .packing import pack
from .quality import fit_quality, score_quality
from .simhash import simhash_groups
from .sizes import word_count
from .substrings import remove_repeats
from .toxicity import fit_toxicity, score_toxicity
from .warc import read_pages, records, write_warc


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return simhash_groups(table(spark, sf, "documents"))


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in batches of 16,384 words at most, padded to 8 optimal lengths."""
    return pack(table(spark, sf, "documents").select("doc_id", word_count("text").alias("n_words")), "n_words")


def severity_grade() -> Column:
    """Grade 0: not toxic. 1: toxic. 2: toxic in a text of low quality."""
    return F.when(F.col("toxic") == 1, F.when(F.col("quality") == 0, 2).otherwise(1)).when(F.col("toxic") == 0, 0)


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Severity of all documents."""
    docs = table(spark, sf, "documents")
    model = fit_toxicity(docs, table(spark, sf, "labels"), severity_grade())
    return score_toxicity(docs.select("doc_id", "text"), model).drop("text")


def held_out() -> Column:
    """Rows that are never learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of all documents, as labels mark it."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf, "labels"), F.col("quality"), where=~held_out())
    return score_quality(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def op5_warc(spark: SparkSession, sf: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    path = shared_dir(spark, "warc")
    write_warc(records(table(spark, sf, "pages")), path)
    return read_pages(spark, path)


def op6_backoff(spark: SparkSession, sf: str) -> DataFrame:
    """Stupid-backoff scores of all documents under the word and pair counts of all documents."""
    return backoff_scores(table(spark, sf, "documents"))


def op7_outliers(spark: SparkSession, sf: str) -> DataFrame:
    """Base rules and robust outliers over all documents."""
    rows = quality_rules(table(spark, sf, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Words that the mix takes of every document."""
    rows = taken_words(mix(table(spark, sf, "documents")))
    return rows.select(rows["id"].alias("doc_id"), "size", "source_size", "target", "taken")


def op9_substrings(spark: SparkSession, sf: str) -> DataFrame:
    """All documents without the passages that earlier documents hold."""
    return remove_repeats(table(spark, sf, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_lattice(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate groups of all embeddings."""
    return embedding_groups(table(spark, sf, "embeddings"))


#: Where the vocabulary files lie on the driver.
TOKENIZERS = "/opt/tokenizers"


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of a byte-level and of a piece vocabulary over all documents, aligned byte by byte."""
    return align_tokens(table(spark, sf, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op12_merkle(spark: SparkSession, sf: str) -> DataFrame:
    """The Merkle manifest of all documents; every fifth or so is claimed with a text in lower case."""
    lowered = {"text": F.translate("text", UPPER, UPPER.lower())}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(table(spark, sf, "documents"), claimed=lowered, where=tampered)


def op13_lines(spark: SparkSession, sf: str) -> DataFrame:
    """All documents without the lines that documents with smaller ids hold."""
    return drop_repeated_lines(table(spark, sf, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_warc": op5_warc,
    "op6_backoff": op6_backoff,
    "op7_outliers": op7_outliers,
    "op8_mixing": op8_mixing,
    "op9_substrings": op9_substrings,
    "op10_lattice": op10_lattice,
    "op11_alignment": op11_alignment,
    "op12_merkle": op12_merkle,
    "op13_lines": op13_lines,
}

def merkle_sql(depth: int = 6) -> str:
    """The manifest level by level, for 16^depth documents a source and 16^depth sources at most."""
    def value(column: str) -> str:
        return f"coalesce(octet_length(encode(CAST({column} AS VARCHAR))) || ':' || CAST({column} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lowered = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
    parts = [
        """crc_table AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i))""",
        """sums AS (SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc FROM documents, crc_table)""",
        f"""leaves AS (SELECT doc_id, coalesce('=' || source, '-') AS tree, {leaf('text')} AS leaf,
    CASE WHEN crc % 5 = 0 THEN {leaf(lowered)} ELSE {leaf('text')} END AS claimed FROM sums)""",
        """p0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, '' AS proof, claimed AS folded
  FROM leaves)""",
        "a0 AS (SELECT tree, pos, leaf AS d FROM p0)",
    ]

    def climb(a: str, p: str) -> None:
        for k in range(depth):
            parts.append(f"""{a}r{k} AS (SELECT tree, pos // 16 AS run, list(d ORDER BY pos) AS ds, any_value(n) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {a}{k}) GROUP BY ALL)""")
            parts.append(f"{a}{k + 1} AS (SELECT tree, run AS pos, CASE WHEN n = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS d FROM {a}r{k})")
            parts.append(f"""{p}{k + 1} AS (SELECT * EXCLUDE (n, l, r)
    REPLACE (pos // 16 AS pos, proof || l || r AS proof, CASE WHEN n = 1 THEN folded ELSE sha256(l || folded || r) END AS folded)
  FROM (SELECT p.*, n, coalesce(array_to_string(ds[1:pos % 16], ''), '') AS l, coalesce(array_to_string(ds[pos % 16 + 2:], ''), '') AS r
    FROM {p}{k} p JOIN {a}r{k} x ON p.tree = x.tree AND pos // 16 = run))""")

    climb("a", "p")
    parts.append(f"subroots AS (SELECT tree AS name, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos FROM a{depth})")
    parts.append("b0 AS (SELECT 'top' AS tree, pos, subroot AS d FROM subroots)")
    parts.append(f"q0 AS (SELECT doc_id, leaf, 'top' AS tree, s.pos, proof, folded, subroot FROM p{depth} JOIN subroots s ON tree = name)")
    climb("b", "q")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = d AS verified FROM q{depth}, b{depth}"""


SQL: dict[str, str] = {
    "op12_merkle": merkle_sql(),
    "op13_lines": f"""
WITH lines AS (SELECT doc_id, row, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{UPPER.lower()}') AS key
  FROM (SELECT doc_id, row, unnest(parts) AS line, unnest(range(len(parts))) AS i
    FROM (SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
firsts AS (SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT l.*, coalesce(l.doc_id > f.first, false) AS gone FROM lines l LEFT JOIN firsts f ON l.key = f.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM marked GROUP BY row""",
    "op5_warc": """
WITH sized AS (SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
firsts AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first_id FROM sized)
SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to FROM firsts""",
    "op8_mixing": r"""
WITH sized AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS src
  FROM sized GROUP BY source),
weighed AS (SELECT *, CAST([5, 2, 1][src % 3 + 1] AS BIGINT) AS weight, 2 * source_size AS cap FROM per),
filled AS (SELECT *, CAST(sum(weight) OVER () - coalesce(sum(weight) OVER f, 0) AS DOUBLE) AS open_weight,
    CAST(1.5 AS DOUBLE) * CAST(sum(source_size) OVER () AS DOUBLE) - CAST(coalesce(sum(cap) OVER f, 0) AS DOUBLE) AS rest
  FROM weighed WINDOW f AS (ORDER BY cap / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT rest, open_weight FROM filled WHERE cap * open_weight > weight * rest ORDER BY cap / weight, src LIMIT 1),
targets AS (SELECT source, source_size, CASE WHEN cap * open_weight <= weight * rest THEN CAST(cap AS DOUBLE)
    ELSE weight * (SELECT rest FROM level) / (SELECT open_weight FROM level) END AS target FROM filled),
keyed AS (SELECT *, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS k FROM sized),
placed AS (SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS pos FROM keyed),
both_ AS (SELECT p.*, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS goal
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  greatest(0, least(size, goal - pos)) + greatest(0, least(size, goal - source_size - pos)) AS taken FROM both_""",
}
