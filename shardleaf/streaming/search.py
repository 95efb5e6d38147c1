"""Each settled, changed query of a stream runs against the index."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from ..operators.events import GAP_SECONDS
from ..operators.search import batch_prefix_join, match_counts
from .changed import changed_bursts
from .debounce import debounce_stream
from .runs import EachBatch, drain, start, with_clock


def find_settled(index: DataFrame) -> EachBatch:
    """What to do with each batch of queries: search the index for all of them at once.

    The batch's size is checked before it is broadcast, and its shards prune the index folders that
    are read.
    """

    def find(batch: DataFrame, _: int) -> DataFrame:
        settled = batch.select("user_id", "ts", F.col("value").alias("q"), F.col("value").alias("text"))
        found = batch_prefix_join(settled, index).withColumnRenamed("text", "q")
        return found.select("user_id", "q", "ts", *index.columns)

    return find


def count_settled(index: DataFrame) -> EachBatch:
    """What to do with each batch of queries: count their matches, and say so where there are none."""

    def count(batch: DataFrame, _: int) -> DataFrame:
        asked = batch.select(F.struct("user_id", "value", "ts").alias("qid"), F.col("value").alias("q"))
        return match_counts(asked, index).select(
            "qid.user_id", F.col("qid.value").alias("q"), "qid.ts", "n_matches", "n_targets", "no_match"
        )

    return count


def settled_queries(events: DataFrame, gap: float = GAP_SECONDS, delay: float = 0, seq: str = "seq") -> DataFrame:
    """(user_id, value, ts) of every settled, non-empty query that differs from the user's last one, as a stream.

    Two stateful operators in one query: session windows settle bursts, and what they release meets the user's last
    value. One checkpoint holds both, so the query may stop and start again anywhere.
    """
    return changed_bursts(debounce_stream(events, gap, delay, seq))


def start_search(
    events: DataFrame, index: DataFrame, target: str, gap: float = GAP_SECONDS, delay: float = 0, seq: str = "seq",
    counts: bool = False, **trigger
) -> StreamingQuery:
    """Search as users type: a query that goes on, with results in target/out/batch_id=N and its progress beside them.

    Started again with the same target, it goes on where it stopped: bursts that were open stay open, and a query that
    ran is not run again. `counts` gives count_settled instead of find_settled; `trigger` is that of runs.start.
    """
    return start(settled_queries(events, gap, delay, seq), target, "append", (count_settled if counts else find_settled)(index), **trigger)


def _searches(events: DataFrame, each: EachBatch, more: list[StructField], gap: float, delay: float, seq: str) -> DataFrame:
    events, strike = with_clock(events)
    settled = settled_queries(events, gap, delay, seq)
    schema = StructType([events.schema["user_id"], StructField("q", StringType()), settled.schema["ts"], *more])
    return drain(settled, "append", each, schema, strike)


def search_stream(events: DataFrame, index: DataFrame, gap: float = GAP_SECONDS, delay: float = 0, seq: str = "seq") -> DataFrame:
    """(user_id, q, ts, entry columns) of every settled, non-empty query that differs from the user's last one,
    over all data present. An empty value, also inside a burst, clears that memory. start_search is the form that goes on.
    """
    return _searches(events, find_settled(index), list(index.schema.fields), gap, delay, seq)


def search_stream_counts(events: DataFrame, index: DataFrame, gap: float = GAP_SECONDS, delay: float = 0, seq: str = "seq") -> DataFrame:
    """(user_id, q, ts, n_matches, n_targets, no_match) of the same queries, those without a match included."""
    more = [StructField("n_matches", LongType()), StructField("n_targets", LongType()), StructField("no_match", BooleanType())]
    return _searches(events, count_settled(index), more, gap, delay, seq)
