"""The catalogue of sections: id, name, label and the shard characters in use."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F


def section_catalog(
    spark: SparkSession,
    names: Mapping[int, str],
    labels: Mapping[int, str],
    chars: Mapping[int, str] | DataFrame,
) -> DataFrame:
    """(section_id, name, label, shard_chars) from three maps on the section number.

    `chars` may also be a frame (section, shard_chars) built from entries; a section without
    entries has no shard characters.
    """
    base = spark.createDataFrame([(i, names[i], labels.get(i, names[i])) for i in names], "section_id int, name string, label string")
    if isinstance(chars, DataFrame):
        known = chars.select(F.col("section").alias("name"), "shard_chars")
        rows = base.join(known, "name", "left")
    else:
        known = spark.createDataFrame(list(chars.items()), "section_id int, shard_chars string")
        rows = base.join(known, "section_id", "left")
    return rows.select("section_id", "name", "label", F.coalesce("shard_chars", F.lit("")).alias("shard_chars"))
