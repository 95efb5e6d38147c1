"""Flat index entries: one row per target of a symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import first_char, match_name, one_line, ready_match_name

COLUMNS = ["section", "shard", "id", "match_name", "label", "url", "same_frame", "scope"]


def symbol_entries(
    df: DataFrame,
    label: Column | str,
    url: Column | str,
    scope: Column | str,
    section: Column | str,
    same_frame: Column | bool = True,
    ready_id: Column | str | None = None,
) -> DataFrame:
    """Any table to flat entries. Without a ready-made id, the id is the match name of the label.

    White space of labels is collapsed and trimmed first, so that an entry is found by what its label shows.
    `section` is a literal name when given as str; the other arguments are columns.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    text = one_line(col(label))
    rows = df.select(
        (F.lit(section) if isinstance(section, str) else section).alias("section"),
        first_char(text).alias("shard"),
        (match_name(F.lower(text)) if ready_id is None else col(ready_id)).alias("id"),
        text.alias("label"),
        col(url).cast("string").alias("url"),
        (F.lit(same_frame) if isinstance(same_frame, bool) else same_frame).alias("same_frame"),
        col(scope).cast("string").alias("scope"),
    )
    name = F.col("id") if ready_id is None else ready_match_name(F.col("id"))
    return rows.select(*[name.alias(c) if c == "match_name" else c for c in COLUMNS])


def nested_entries(df: DataFrame) -> DataFrame:
    """Nested rows (section, id, label, targets array<struct<url, same_frame, scope>>) to flat entries.

    A field `copies` in the struct gives that many rows; they are counted out in two steps, so that no row
    holds them all.
    """
    flat = df.select("section", "id", "label", F.explode("targets").alias("t"))
    if "copies" in df.schema["targets"].dataType.elementType.names:
        step = 1000
        flat = flat.withColumn("_a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("t.copies") - 1, F.lit(step).cast("long"))))
        flat = flat.withColumn("_b", F.explode(F.sequence(F.col("_a"), F.least(F.col("_a") + step, F.col("t.copies")) - 1)))
    return symbol_entries(
        flat, "label", F.col("t.url"), F.col("t.scope"), F.col("section"), F.col("t.same_frame"), ready_id="id"
    )
