"""Text sizes in words, in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    """Number of words of a text (runs of other characters than U+0020 and U+0009 to U+000D); null gives 0."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")
