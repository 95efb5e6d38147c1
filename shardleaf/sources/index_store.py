"""The index on disk: parquet, one folder per (section, shard)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import first_char
from ..plans import cut_lineage

# Partition values such as 2 look like numbers, so the reader is told the types.
SCHEMA = (
    "id string, match_name string, label string, url string, same_frame boolean, scope string, "
    "section string, shard string"
)


ROWS_PER_FILE = 2_000_000
MAX_FILES = 10_000  # the driver holds a sample of so many rows per range partition


def write_index(entries: DataFrame, path: str, files: int | None = None, mode: str = "overwrite", stage: bool = True) -> None:
    """Write entries that have a shard (a non-blank label), sorted by match name within files.

    Rows are range-partitioned on (section, shard, match_name, target): a popular first letter is
    cut into several files instead of one task, and each file holds a narrow range of match names,
    so a prefix filter skips row groups. The range bounds come from a sample, which would compute
    the entries twice; entries that come out of a long job are staged in the shared folder instead.
    Pass stage=False for entries that are read from a table. Without `files`, the rows decide how
    many range partitions there are.
    """
    order = ["section", "shard", "match_name", "label", "url", "scope"]
    rows = entries.where("shard is not null").select("section", "shard", "id", "match_name", "label", "url", "same_frame", "scope")
    if stage:
        rows = cut_lineage(rows)
    keys = [*order, "_salt"]  # the salt spreads copies of one entry
    rows = rows.withColumn("_salt", F.rand(5))
    files = files or min(MAX_FILES, max(1, math.ceil(rows.count() / ROWS_PER_FILE)))
    (
        rows.repartitionByRange(files, *keys)
        .drop("_salt")
        .sortWithinPartitions(*order)
        .write.mode(mode)
        .partitionBy("section", "shard")
        .parquet(path)
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path).select(
        "section", "shard", "id", "match_name", "label", "url", "same_frame", "scope"
    )


def read_shard(spark: SparkSession, path: str, section: str, char: str) -> DataFrame:
    """Entries of one shard; empty when there is no such shard. Reads that folder only."""
    return read_index(spark, path).where((F.col("section") == section) & (F.col("shard") == first_char(F.lit(char))))
