"""Searches set off by queries and section choices, from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .debounce import _interval
from .state import BUCKETS, InOrder


class _Facets(InOrder):
    PAYLOAD = {"q": "string", "section_id": "int"}
    OUTPUT = {"q": "string", "section_id": "int", "us": "long", "seq": "long"}
    MEMORY = PAYLOAD

    def __init__(self, default_section: int) -> None:
        self.default_section = default_section

    def first(self):
        return None, self.default_section

    def on_rows(self, rows, memory):
        query, section = memory
        out = []
        for us, seq, new_query, new_section in rows:
            query = query if new_query is None else new_query
            section = section if new_section is None else int(new_section)
            if query and query.strip(" "):
                out.append((query, section, us, seq))
        return out, (query, section)


def facet_stream(queries: DataFrame, choices: DataFrame, delay: float = 0, default_section: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """(user_id, q, section_id, ts, seq): a query runs in the chosen section, a choice re-runs the query.

    queries is (user_id, q, ts, seq) and choices (user_id, section_id, ts, seq), both streams.
    """
    both = queries.select("user_id", "ts", "seq", "q", F.lit(None).cast("int").alias("section_id")).unionByName(
        choices.select("user_id", "ts", "seq", F.lit(None).cast("string").alias("q"), F.col("section_id").cast("int").alias("section_id"))
    )
    rows = both.withWatermark("ts", _interval(delay)).withColumns({
        "us": F.unix_micros("ts"), "seq": F.coalesce(F.col("seq").cast("long"), F.lit(0)),
    })
    return _Facets(default_section).over(rows, "user_id", buckets).select("user_id", "q", "section_id", F.timestamp_micros("us").alias("ts"), "seq")
