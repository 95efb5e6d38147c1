"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame operations only.

Each source gets a target of words: weights share 1.5 times all words, none above twice its source.
Each source is a stream: its documents in an order fixed by a hash of their ids, read once and then
once more. The stream is cut into blocks of equal words. The schedule has one slot per block that the
targets ask for. The slots are the points of a van der Corput sequence: slot i sits at the bit reversal
of i, and the cumulated weights say which source owns that place, so that any stretch of the schedule
holds the sources nearly in proportion. A source's slots are ranked, and slot rank r takes block r.

Nothing is ordered in one task: a source's documents and slots are split into ranges of the hash or of
the slot number, summed inside the ranges, and shifted by the sums of the ranges before, a table of at
most RANGES rows per source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans import broadcast_if_small, cut_lineage
from .columns import restore, set_aside
from .sizes import word_count

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
REPEATS = 2
BLOCK_WORDS = 65_536
MIN_SLOTS = 65_536
RANGE_BITS = 11
RANGES = 1 << RANGE_BITS
_FAN = 4096


@dataclass
class Mix:
    """sources: src, source, source_size, weight, target, words, lo, slots. documents: id, src, size, start. pieces: slot,
    src, block, id, size, start, taken: the words of a document that a slot takes."""

    sources: DataFrame
    documents: DataFrame
    pieces: DataFrame
    block_words: int


def order_key(id_col: str | Column) -> Column:
    """60 bits of the MD5 of the id as text; null counts as empty text."""
    text = F.coalesce(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, budget: float = BUDGET, repeats: int = REPEATS, weights: tuple[int, ...] = WEIGHTS
) -> DataFrame:
    """(source, size) to (src, source, source_size, weight, target): one row per source, by code point, null last.

    Weights share `budget` times all sizes; a target stops at `repeats` times its source's size, and what
    is over goes to the others by weight until none is above. The sources fill in the order of
    repeats * size / weight, so those that are full are a prefix of that order, found with running sums.
    """
    per = cut_lineage(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    per = per.withColumn("src", F.row_number().over(by_name) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int")))
    per = per.withColumn("_cap", repeats * F.col("source_size"))
    fill = Window.orderBy(F.col("_cap") / F.col("weight"), "src").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumns({
        "_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(fill), F.lit(0)),
        "_rest": F.lit(float(budget)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(fill), F.lit(0)),
    })
    full = F.col("_cap") * F.col("_left").cast("double") <= F.col("weight") * F.col("_rest")
    open_ = F.when(~full, F.struct(F.col("_cap") / F.col("weight"), "src", "_left", "_rest"))
    per = per.withColumn("_first_open", F.min(open_).over(everything))
    level = F.col("weight") * F.col("_first_open._rest") / F.col("_first_open._left")
    return per.select("src", "source", "source_size", "weight", F.when(full, F.col("_cap").cast("double")).otherwise(level).alias("target"))


def _starts(rows: DataFrame, key: str, range_col: str, order: list[str], measure: Column, out: str) -> DataFrame:
    """Running sum of measure before each row, per key: inside ranges, plus the ranges before."""
    within = Window.partitionBy(key, range_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(key).orderBy(range_col).rowsBetween(Window.unboundedPreceding, -1)
    ranges = cut_lineage(rows.groupBy(key, range_col).agg(F.sum(measure).alias("_sum")))
    ranges = ranges.select(key, range_col, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    placed = rows.withColumn("_in", F.sum(measure).over(within) - measure)
    return placed.join(ranges, [key, range_col]).withColumn(out, F.col("_base") + F.col("_in")).drop("_base", "_in")


def _slots(sources: DataFrame, bits: int) -> DataFrame:
    """(src, block, slot): the slots of each source, ranked by their place in the schedule."""
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(_FAN).cast("long")))
    fans = sources.where("slots > 0").select("src", "lo", "slots", first.alias("_a")).repartition("src", "_a")
    place = F.explode(F.sequence(F.col("_a"), F.least(F.col("_a") + (_FAN - 1), F.col("slots") - 1)))
    points = fans.select("src", "lo", place.alias("_p"))
    reversed_bits = F.conv(F.reverse(F.lpad(F.bin(F.col("lo") + F.col("_p")), bits, "0")), 2, 10).cast("long")
    slots = points.select("src", reversed_bits.alias("slot"))
    slots = slots.withColumn("_range", F.shiftright("slot", max(0, bits - RANGE_BITS)))
    ranked = _starts(slots, "src", "_range", ["slot"], F.lit(1).cast("long"), "block")
    return ranked.select("src", "block", "slot")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", budget: float = BUDGET,
    repeats: int = REPEATS, weights: tuple[int, ...] = WEIGHTS, block_words: int = BLOCK_WORDS, min_slots: int = MIN_SLOTS,
) -> Mix:
    """Mix whole sources to their target weights. See Mix for the tables.

    A block has block_words words, or fewer so that the schedule has min_slots slots; each source has as
    many slots as its target needs, the last one cut to it, so that its words taken are its target rounded.
    Null texts and texts without words have size 0 and take nothing. A null source is a source of its own,
    ordered last. Rows with one id and size are interchangeable. An empty table gives empty tables. Other columns are
    not read, whatever their names.
    """
    sized = cut_lineage(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size")))
    targets = cut_lineage(source_targets(sized.select("source", "size"), budget, repeats, weights))
    total = targets.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    block = max(1, min(block_words, int(total // min_slots)))
    by_src = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, -1)
    sources = targets.withColumn("words", F.floor(F.col("target") + 0.5))
    sources = sources.withColumn("slots", F.ceil(F.col("words") / block).cast("long"))
    sources = cut_lineage(sources.withColumn("lo", F.coalesce(F.sum("slots").over(by_src), F.lit(0))))
    n = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    slots = _slots(sources, max(1, (max(n, 2) - 1).bit_length()))

    names = sources.select("source", "src", "source_size", "words")
    named = sized.join(names.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    keyed = named.withColumn("_key", order_key("id")).withColumn("_range", F.shiftright("_key", 60 - RANGE_BITS))
    placed = _starts(keyed, "src", "_range", ["_key", "id", "size"], F.col("size"), "start")
    documents = cut_lineage(placed.select("id", "src", "size", "start", "source_size", "words"))

    again = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    spans = documents.where("size > 0").withColumn("_pass", again).withColumn("_from", F.col("_pass") * F.col("source_size") + F.col("start"))
    spans = spans.withColumn("_to", F.least(F.col("_from") + F.col("size"), "words")).where("_from < _to")
    blocks = F.sequence(F.floor(F.col("_from") / block), F.floor((F.col("_to") - 1) / block))
    parts = spans.withColumn("block", F.explode(blocks))
    taken = F.least("_to", (F.col("block") + 1) * block) - F.greatest("_from", F.col("block") * block)
    parts = parts.select("src", "block", "id", "size", "start", taken.alias("taken"))
    return Mix(sources, documents, parts.join(slots, ["src", "block"]), block)


def taken_words(mixed: Mix) -> DataFrame:
    """(id, source, size, source_size, target, taken): one row per document with the words the mix takes, repeats counted."""
    taken = cut_lineage(mixed.pieces.groupBy("src", "start", "id", "size").agg(F.sum("taken").alias("taken")))
    taken = taken.select(F.col("src").alias("_src"), F.col("start").alias("_start"), "taken")
    on = (F.col("src") == F.col("_src")) & (F.col("start") == F.col("_start")) & (F.col("size") > 0)
    sources = mixed.sources.select(F.col("src").alias("_s"), "source", "target")
    rows = mixed.documents.join(taken, on, "left").join(sources, F.col("src") == F.col("_s"))
    return rows.select("id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def read_rows(docs: DataFrame, mixed: Mix, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", repeats: int = REPEATS) -> DataFrame:
    """The rows of docs as often as the mix reads them, whole or in part: up to `repeats` times, with all their columns.

    A source is read in the order of its documents' keys, so what is read r times or more is everything up to
    one last document. Rows are compared with these places, one per source, and no text is moved. Rows that share id,
    source and size share the decision (the larger).
    """
    place = F.struct(order_key("id").alias("key"), F.col("id").alias("id"), F.col("size").alias("size"))
    times = F.ceil(F.col("taken") / F.col("size"))
    lasts = [F.max(F.when(times >= r, place)).alias(f"last_{r}") for r in range(1, repeats + 1)]
    ends = taken_words(mixed).where("taken > 0").groupBy(F.col("source").alias("of")).agg(*lasts)
    ends = broadcast_if_small(cut_lineage(ends))
    rows = set_aside(docs, source=F.col(source_col), id=F.col(id_col), size=word_count(text_col)).where("size > 0")
    rows = rows.join(ends, F.col("source").eqNullSafe(F.col("of"))).withColumn("place", place)
    reads = sum((F.when(F.col("place") <= F.col(f"last_{r}"), 1).otherwise(0) for r in range(1, repeats + 1)), F.lit(0))
    rows = rows.withColumn("reads", reads).where("reads > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("reads"))).alias("read"))
    return restore(rows, docs.columns)
