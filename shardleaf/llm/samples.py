"""Bounded samples of labelled rows to fit models on. Everything else in this subpackage reads all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..plans import cut_lineage


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, label: Column, limit: int, where: Column | None = None) -> DataFrame:
    """Whole rows of docs (columns id_col and the others given) with column label: `limit` labelled ids at most, those
    with the smallest hash of the id. Rows with a null id or label are not labelled; an id labelled twice counts
    with its largest label. Only the sampled ids, a bounded number, are broadcast."""
    known = labels.select(F.col(id_col), label.alias("label")).where(F.col(id_col).isNotNull() & F.col("label").isNotNull())
    if where is not None:
        known = known.where(where)
    known = known.groupBy(id_col).agg(F.max("label").alias("label"))
    if limit is not None:
        known = known.orderBy(F.xxhash64(id_col), id_col).limit(limit)
    return cut_lineage(docs.join(F.broadcast(known), id_col))
