"""Whole-text jobs: page text, blank lines, fold summaries. All narrow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.text import decode_entities, fold_line, without_elements, without_tags
from ..functions.text import tidy_blank_lines as tidy

# Parts of a listing that are not part of its text.
LISTING_EXTRAS = (".lineno", ".ttc", ".foldclosed")
PAGE_EXTRAS = ("script", "style")


def page_text(pages: DataFrame, drop: Sequence[str] = (*PAGE_EXTRAS, *LISTING_EXTRAS)) -> DataFrame:
    """(page_id, text) without the dropped elements (`tag`, `.class` or `tag.class`) and without tags."""
    bare = without_tags(without_elements(F.col("html"), drop))
    return pages.select("page_id", bare.alias("bare")).select("page_id", tidy(decode_entities("bare")).alias("text"))


def tidy_blank_lines(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", tidy(F.col("text")))


def fold_summary(blocks: DataFrame) -> DataFrame:
    """(block_id, summary) of foldable blocks (block_id, start, end, text)."""
    return blocks.select("block_id", fold_line(F.col("start"), F.col("end"), F.col("text")).alias("summary"))
