"""Prefix search over flat index entries, one query or many."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, Window, functions as F

from ..functions.text import first_char, match_name, normal_query, squeezed
from ..plans import broadcast_if_small, cut_lineage, numbered, prefix_ranges
from ..plans.bounds import MAX_BYTES, MAX_ROWS
from ..plans.ordered import fits

EVERY = "all"
ITEM = ["section", "shard", "id", "label"]
TARGET = ["url", "same_frame", "scope"]
# Index order: by match name, then label, then target.
INDEX_ORDER = ["match_name", "label", "section", "id", "scope", "url", "same_frame"]

# Up to this many shards are named in the filter that prunes the index folders; beyond that the join alone
# decides, with the same result.
PRUNE_SHARDS = 500
TARGETS_PER_PART = 100_000


def normalize_queries(queries: DataFrame, q: str = "q") -> DataFrame:
    """Add q_norm (for matching) and q_squeezed (for change detection)."""
    return queries.withColumns({"q_norm": normal_query(F.col(q)), "q_squeezed": squeezed(F.col(q))})


def encode_match_names(df: DataFrame, text: str, out: str = "match_name") -> DataFrame:
    """Add the match name of a lower-cased text column."""
    return df.withColumn(out, match_name(F.lower(F.col(text))))


def assign_shards(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add shard, pos and shard_name to (q, section_id); pos -1 and no name when there is no such shard."""
    known = broadcast_if_small(catalog.select("section_id", "name", "shard_chars"))
    found = F.coalesce(F.instr("shard_chars", F.col("shard")), F.lit(0))
    pos = (found - 1).cast("int")
    return (
        df.withColumn("shard", first_char(F.col("q")))
        .join(known, "section_id", "left")
        .withColumn("pos", pos)
        .withColumn("shard_name", F.when(F.col("pos") >= 0, F.concat("name", F.lit("_"), F.lower(F.hex("pos")))))
        .drop("name", "shard_chars")
    )


def prefix_search(entries: DataFrame, q: str) -> DataFrame:
    """Entries of all sections whose match name starts with the query; none for an empty query.

    The query is folded to a literal, so the parquet scan gets a shard filter and a prefix filter.
    """
    text = F.lit(q)
    return entries.where(
        (F.col("shard") == first_char(text)) & F.startswith(F.col("match_name"), match_name(normal_query(text)))
    )


def section_search(entries: DataFrame, section: str, q: str) -> DataFrame:
    """Prefix search within one section; "all" is every section, each entry once."""
    if section == EVERY:
        return all_section(prefix_search(entries, q), EVERY)
    return prefix_search(entries.where(F.col("section") == section), q)


def _prepared(queries: DataFrame) -> tuple[DataFrame, list[str]]:
    """Add shard and the encoded text; an empty query has no shard."""
    keys = (["section"] if "section" in queries.columns else []) + ["shard", "q_enc"]
    text = F.col("q")
    ready = queries.withColumns({"shard": first_char(text), "q_enc": match_name(normal_query(text))})
    return ready, keys


def _seen(wanted: DataFrame) -> Row:
    """One pass over prepared queries: the lengths that occur (at most as many as the longest query has characters), the
    shards (at most one per character in use), whether a query asks for all sections, and their number and size."""
    row_bytes = F.octet_length(F.to_json(F.struct("*"))).cast("long")
    every = (F.col("section") == EVERY) if "section" in wanted.columns else F.lit(False)
    return wanted.select("shard", F.length("q_enc").alias("length"), row_bytes.alias("bytes"), every.alias("every")).agg(
        F.collect_set("length").alias("lengths"), F.collect_set("shard").alias("shards"),
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.max("every").alias("every"),
    ).first()


def _reachable(entries: DataFrame, seen: Row) -> DataFrame:
    """Entries in shards that are asked for, which prunes the index folders; with section "all" if that is."""
    if len(seen["shards"]) <= PRUNE_SHARDS:
        entries = entries.where(F.col("shard").isin(seen["shards"]))
    if seen["every"]:
        named = entries.where(~F.col("section").eqNullSafe(F.lit(EVERY)))
        entries = named.unionByName(all_section(entries))
    return entries


def _candidates(wanted: DataFrame, entries: DataFrame) -> tuple[DataFrame, bool]:
    """Entries with a q_enc column that makes the prefix test an equi-join; and whether wanted is small.

    An entry gets one row per query length that occurs (not per query), so no query is compared with a whole shard.
    """
    seen = _seen(wanted)
    lengths = F.split(F.lit(",".join(map(str, sorted(seen["lengths"]))) or "0"), ",").cast("array<int>")
    cuts = F.filter(lengths, lambda n: n <= F.length("match_name"))
    rows = _reachable(entries, seen).withColumn("_cut", F.explode(cuts)).withColumn(
        "q_enc", F.substring("match_name", F.lit(1), F.col("_cut"))
    )
    return rows.drop("_cut"), seen["rows"] <= MAX_ROWS and seen["bytes"] <= MAX_BYTES


def batch_prefix_join(queries: DataFrame, entries: DataFrame) -> DataFrame:
    """(query columns but q, entry columns) for every query and every entry that it finds.

    With a `section` column each query stays in its section ("all": every section, each entry once), otherwise it
    searches all of them.
    """
    ready, keys = _prepared(queries)
    wanted = cut_lineage(ready.where("shard is not null").drop("q"))
    rows, small = _candidates(wanted, entries)
    return (F.broadcast(wanted) if small else wanted).join(rows, keys).drop("q_enc")


def _asked(queries: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Prepared queries as a written table, the distinct ones that can find something, and the keys of both."""
    ready, keys = _prepared(queries)
    ready = cut_lineage(ready.select("qid", *keys))
    return ready, cut_lineage(ready.where("shard is not null").select(*keys).distinct()), keys


def match_counts(queries: DataFrame, entries: DataFrame, max_rows: int | None = None) -> DataFrame:
    """(qid, n_matches, n_targets, no_match) per query, zero included.

    n_matches counts results (symbols), n_targets the entries under them. The distinct names of a shard are sorted once
    with both ends of each distinct query among them, and a count is the difference of running sums at the
    ends; a shard of more than max_rows names is split.
    """
    ready, wanted, keys = _asked(queries)
    place = keys[:-1]
    items = _reachable(entries, _seen(wanted)).groupBy(*ITEM, "match_name").agg(F.count(F.lit(1)).alias("_targets"))
    names = items.groupBy(*place, "match_name").agg(F.count(F.lit(1)).alias("n_matches"), F.sum("_targets").alias("n_targets"))
    _, ranges = prefix_ranges(names, wanted, place, "match_name", "q_enc", ["n_matches", "n_targets"], max_rows=max_rows)
    counts = cut_lineage(ranges.where("n_rows > 0").drop("first", "n_rows"))
    return ready.join(broadcast_if_small(counts), keys, "left").select(
        "qid",
        F.coalesce("n_matches", F.lit(0)).alias("n_matches"),
        F.coalesce("n_targets", F.lit(0)).alias("n_targets"),
        F.col("n_matches").isNull().alias("no_match"),
    )


def first_match(queries: DataFrame, entries: DataFrame, max_rows: int | None = None) -> DataFrame:
    """(qid, first entry in index order) for each query that finds something.

    The rank of a query's lower end is that of the first name it finds, so the name is looked up by rank, and of the
    entries under that name alone the least is taken.
    """
    ready, wanted, keys = _asked(queries)
    place = keys[:-1]
    reachable = _reachable(entries, _seen(wanted))
    names = reachable.select(*place, "match_name").distinct()
    ranks, ranges = prefix_ranges(names, wanted, place, "match_name", "q_enc", max_rows=max_rows)
    found = ranges.where("n_rows > 0").withColumnRenamed("first", "rank").join(ranks, [*place, "rank"]).select(*keys, "match_name")
    found = cut_lineage(found)
    firsts = broadcast_if_small(found.select(*place, "match_name").distinct())
    rest = [c for c in entries.columns if c not in INDEX_ORDER]
    under = reachable.join(firsts, [*place, "match_name"]).groupBy(*place, "match_name").agg(F.min(F.struct(*INDEX_ORDER, *rest)).alias("best"))
    best = cut_lineage(found.join(under, [*place, "match_name"]).select(*keys, "best"))
    return ready.join(broadcast_if_small(best), keys).select("qid", "best.*")


def group_results(matches: DataFrame, per_part: int = TARGETS_PER_PART) -> DataFrame:
    """(section, id, label, part, targets, n_targets, is_group): targets nested under their symbol.

    Copies of a target are combined before the shuffle and kept as a count in the struct. The distinct
    targets of a symbol are numbered in target order, and every per_part of them are a row: part 0, 1, ..
    n_targets is the total of the symbol.
    """
    key = ["section", "id", "label"]
    order = ["scope", "url", "same_frame"]
    distinct = cut_lineage(matches.groupBy(*key, *TARGET).agg(F.count(F.lit(1)).alias("copies")))
    placed = numbered(distinct, key, order, "_child").withColumn("part", F.floor(F.col("_child") / per_part).cast("int"))
    rows = placed.groupBy(*key, "part").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct(*order, "copies"))),
            lambda t: F.struct(t["url"].alias("url"), t["same_frame"].alias("same_frame"), t["scope"].alias("scope"), t["copies"].alias("copies")),
        ).alias("targets"),
        F.sum("copies").alias("_copies"),
    )
    rows = rows.withColumn("n_targets", F.sum("_copies").over(Window.partitionBy(*key))).drop("_copies")
    return rows.withColumn("is_group", F.col("n_targets") > 1)


def item_index(entries: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Add item_index (0-based, per section and shard) and child_index (0-based, per item).

    One shuffle and one sort give both numbers, unless a shard is too big for a task. Then items and
    targets are numbered apart, in split groups, and joined.
    """
    shard, item, target = ["section", "shard"], ["match_name", "label", "id"], ["scope", "url", "same_frame"]
    if fits(entries, shard, max_rows):
        child = Window.partitionBy(*shard, *item).orderBy(*target)
        rows = entries.withColumn("child_index", F.row_number().over(child).cast("long") - 1)
        place = Window.partitionBy(*shard).orderBy(*item)
        return rows.withColumn("item_index", F.dense_rank().over(place).cast("long") - 1)
    items = numbered(entries.select(*shard, *item).distinct(), shard, item, "item_index", max_rows)
    children = numbered(entries, [*shard, *item], target, "child_index", max_rows)
    left, right = children.alias("c"), items.alias("i")
    on = [F.col(f"c.{k}").eqNullSafe(F.col(f"i.{k}")) for k in [*shard, *item]]
    return left.join(right, on).select("c.*", "i.item_index")


def build_catalog(entries: DataFrame) -> DataFrame:
    """(section, shard_chars): distinct first characters of a section, sorted, as one string."""
    chars = entries.where("shard is not null").select("section", "shard").distinct()
    return chars.groupBy("section").agg(F.array_join(F.sort_array(F.collect_list("shard")), "").alias("shard_chars"))


def all_section(entries: DataFrame, name: str = EVERY) -> DataFrame:
    """Entries of the section "all": the union of the named sections, each entry once."""
    return entries.withColumn("section", F.lit(name)).dropDuplicates()


def catalog_audit(catalog: DataFrame, name: str = EVERY) -> DataFrame:
    """(char, side): characters that only "all" has, and those that only a named section has.

    Takes section_catalog (with `name`) or build_catalog (with `section`).
    """
    section = "name" if "name" in catalog.columns else "section"
    chars = catalog.select(F.col(section).alias("section"), F.explode(F.split("shard_chars", "")).alias("char"))
    everything = chars.where(F.col("section") == name).select("char")
    named = chars.where(F.col("section") != name).select("char")
    return everything.subtract(named).withColumn("side", F.lit("all_only")).unionByName(
        named.subtract(everything).withColumn("side", F.lit("section_only"))
    )
