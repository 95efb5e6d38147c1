"""All columns of a table as one struct, so that no helper column beside it can clash with a name in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def set_aside(docs: DataFrame, **helpers: Column) -> DataFrame:
    """(row, helpers): every column of docs in the struct `row`, helper columns over docs beside it."""
    return docs.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in helpers.items()])


def restore(rows: DataFrame, names: list[str], **new: Column) -> DataFrame:
    """The columns `names` out of `row`; new ones take the place of a column of that name, or come after the others."""
    by_name = {name.lower(): c for name, c in new.items()}
    out = [by_name.pop(name.lower(), F.col("row").getField(name)).alias(name) for name in names]
    return rows.select(*out, *[c.alias(name) for name, c in new.items() if name.lower() in by_name])
