"""A corpus from raw documents to packed batches, in five stages. Each stage reads all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardleaf.llm.mixing import mix, read_rows
from shardleaf.llm.packing import pack
from shardleaf.llm.queries import severity_grade, table
from shardleaf.llm.simhash import one_per_group
from shardleaf.llm.sizes import word_count
from shardleaf.llm.substrings import cut_texts
from shardleaf.llm.toxicity import fit_toxicity, without_toxic
from shardleaf.plans import cut_lineage

#: SQL can express neither the fitted model nor the hashes; tests compare the stages with brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose severity is more likely above 0 than not."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), severity_grade())
    return without_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: texts with a Jaccard similarity of 0.8 or more in runs of five words."""
    return one_per_group(docs, width=5, similarity=0.8)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that earlier documents hold; n_chars follows."""
    return cut_texts(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix reads it, whole or in part: never, once or twice.

    Rows that share id, source and size share the decision (the larger).
    """
    return read_rows(docs, mix(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every reading of a document with its place in a batch."""
    return pack(docs.select("doc_id", "lang", "source", word_count("text").alias("n_words")), "n_words")


STAGES = [
    ("toxicity", toxicity), ("simhash_near_dedup", near_duplicates), ("substring_dedup", substrings), ("mixing", mixing), ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
