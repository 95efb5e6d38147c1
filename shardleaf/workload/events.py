"""Queries on event rules: the batch forms, then the streams run over all data present."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import streaming as st
from ..operators import events as op
from ..sources import symbol_entries
from ..streaming.runs import as_local
from .inputs import CHANGES, EVENTS_K, field_changes, log_of, sql_match_name, sql_shard, table, with_k

GAP = 3600.0
ORDER = ["ts", "seq"]


def changes(spark, sf):
    return field_changes(table(spark, sf, "events"))


def facet_events(events):
    """Purchases choose a section, signups empty the query, other events are queries."""
    ev = with_k(events)
    choice = F.col("event_type") == "purchase"
    query = F.when(F.col("event_type") == "signup", F.lit("")).otherwise(F.col("event_type"))
    return ev.select(
        "user_id", F.when(~choice, query).alias("q"), F.when(choice, F.col("k") % 4).cast("int").alias("section_id"),
        "ts", F.col("event_id").alias("seq"),
    )


def live(spark, sf):
    return st.read_events(spark, f"{sf}/events.parquet*", table(spark, sf, "events").schema)


def q_debounce_stream(spark, sf):
    events, strike = st.with_clock(field_changes(live(spark, sf)))
    rows = st.drain(st.debounce_stream(events, GAP), strike=strike)
    return rows.select("user_id", "value", as_local(F.col("ts")).alias("ts"), "had_reset")


def typed_and_index(spark, sf):
    """Users type names of parts, all of them in turn, every other one misspelt; the index holds the part names."""
    part = table(spark, sf, "part")
    named = F.col("event_id") % part.count() == F.col("p_partkey")
    text = F.when(F.col("event_id") % 2 == 0, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" x")))
    typed = live(spark, sf).join(part, named).select("user_id", text.alias("value"), "ts", F.col("event_id").alias("seq"))
    names = part.select("p_name").distinct()
    index = symbol_entries(names, "p_name", "p_name", F.lit(""), "names")
    return typed, index


def q_search_stream(spark, sf):
    rows = st.search_stream(*typed_and_index(spark, sf), GAP)
    return rows.select("user_id", "q", as_local(F.col("ts")).alias("ts"), "section", "match_name", "label")


def q_search_counts(spark, sf):
    rows = st.search_stream_counts(*typed_and_index(spark, sf), GAP)
    return rows.select("user_id", "q", as_local(F.col("ts")).alias("ts"), "n_matches", "n_targets", "no_match")


def q_changed_stream(spark, sf):
    events, strike = st.with_clock(field_changes(live(spark, sf)))
    rows = st.drain(st.changed_stream(events), strike=strike)
    return rows.select("user_id", "value", as_local(F.col("ts")).alias("ts"), "seq")


def q_settings_stream(spark, sf):
    """The last operation of each key, as the stream reported it."""
    ops = st.drain(st.settings_stream(log_of(live(spark, sf))), "update")
    rank = F.struct("batch_id", (F.col("op") == "expire").alias("late"))
    last = ops.groupBy("scope_id", "key").agg(F.max_by(F.struct("value", "op"), rank).alias("w"))
    return last.select("scope_id", "key", "w.value", "w.op")


def q_toggle_stream(spark, sf):
    clicks = live(spark, sf).where("event_type = 'click'").select(F.col("user_id").cast("string").alias("id"))
    states = st.drain(st.toggle_stream(clicks), "update")
    return states.groupBy("id").agg(F.max_by("is_open", "batch_id").alias("is_open"))


def q_toggle_all_stream(spark, sf):
    ev = with_k(live(spark, sf)).where("event_type in ('click', 'signup')")
    is_all = F.col("event_type") == "signup"
    clicks = ev.select(
        F.col("user_id").alias("page_id"), F.when(~is_all, F.col("k").cast("string")).alias("id"), is_all.alias("is_all"),
        "ts", F.col("event_id").alias("seq"),
    )
    clicks, strike = st.with_clock(clicks)
    told = st.drain(st.toggle_all_stream(clicks), strike=strike, key="page_id")
    # What holds now: the last word on the whole page, and the last on each block since then.
    told = told.groupBy("page_id", "id").agg(F.max_by("is_open", "batch_id").alias("is_open"), F.max("batch_id").alias("b"))
    whole = told.where("id is null").select("page_id", F.col("b").alias("reset"))
    return told.join(whole, "page_id", "left").where("reset is null or b >= reset").select("page_id", "id", "is_open")


def q_facet_stream(spark, sf):
    both = facet_events(live(spark, sf))
    queries, strike = st.with_clock(both.where("q is not null").select("user_id", "q", "ts", "seq"))
    choices = facet_events(live(spark, sf)).where("section_id is not null").select("user_id", "section_id", "ts", "seq")
    rows = st.drain(st.facet_stream(queries, choices), strike=strike)
    return rows.select("user_id", "q", "section_id", as_local(F.col("ts")).alias("ts"), "seq")


QUERIES = {
    "changed_only": lambda s, sf: op.changed_only(changes(s, sf), ["user_id"], "value", ORDER),
    "debounce_batch": lambda s, sf: op.debounce_batch(changes(s, sf), ["user_id"], ORDER, GAP),
    "settled_bursts": lambda s, sf: op.settled_bursts(changes(s, sf), ["user_id"], "value", ORDER, GAP),
    "facet_batch": lambda s, sf: op.facet_batch(facet_events(table(s, sf, "events")), ["user_id"], ORDER),
    "debounce_stream": q_debounce_stream,
    "search_stream": q_search_stream,
    "search_stream_counts": q_search_counts,
    "changed_stream": q_changed_stream,
    "settings_stream": q_settings_stream,
    "toggle_stream": q_toggle_stream,
    "toggle_all_stream": q_toggle_all_stream,
    "facet_stream": q_facet_stream,
}

_W = "OVER (PARTITION BY user_id ORDER BY ts, seq)"
_GAP = "INTERVAL 1 HOUR"
_BURSTS = f"""{CHANGES},
marked AS (SELECT *, lead(ts) {_W} AS nxt, coalesce(ts >= lag(ts) {_W} + {_GAP}, TRUE) AS starts FROM changes),
numbered AS (SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) {_W} AS burst FROM marked),
bursts AS (SELECT user_id, arg_max(value, (ts, seq)) AS value, max(ts) AS ts, bool_or(value = '') AS had_reset
  FROM numbered GROUP BY user_id, burst)"""
_CHANGED = f"""{CHANGES},
changed AS (SELECT * FROM (SELECT *, lag(value) {_W} AS before FROM changes) WHERE value <> '' AND value IS DISTINCT FROM before)"""
_FACETS = f"""{EVENTS_K},{CHANGES},
f AS (SELECT user_id, CASE event_type WHEN 'purchase' THEN NULL WHEN 'signup' THEN '' ELSE event_type END AS q,
  CASE WHEN event_type = 'purchase' THEN k % 4 END AS s, ts, event_id AS seq FROM ev),
facets AS (SELECT * FROM (SELECT user_id, last_value(q IGNORE NULLS) {_W} AS q,
  CAST(coalesce(last_value(s IGNORE NULLS) {_W}, 0) AS INTEGER) AS section_id, ts, seq FROM f) WHERE q <> '')"""

_SEARCHES = f"""{EVENTS_K},
typed AS (SELECT user_id, CASE WHEN event_id % 2 = 0 THEN p_name ELSE p_name || ' x' END AS q, ts, event_id AS seq
  FROM ev JOIN part ON event_id % (SELECT count(*) FROM part) = p_partkey),
closed AS (SELECT * FROM (SELECT *, lead(ts) {_W} AS nxt FROM typed) WHERE nxt IS NULL OR nxt >= ts + {_GAP}),
searched AS (SELECT * FROM (SELECT *, lag(replace(q, ' ', '')) {_W} AS before FROM closed) WHERE replace(q, ' ', '') IS DISTINCT FROM before),
names AS (SELECT DISTINCT p_name AS label, {sql_shard('p_name')} AS shard, {sql_match_name('lower(p_name)')} AS match_name FROM part)"""

SQL = {
    "changed_only": f"WITH {_CHANGED} SELECT user_id, value, ts, seq FROM changed",
    "debounce_batch": f"WITH {_BURSTS} SELECT user_id, value, ts, seq FROM marked WHERE nxt IS NULL OR nxt >= ts + {_GAP}",
    "settled_bursts": f"WITH {_BURSTS} SELECT * FROM bursts",
    "facet_batch": f"WITH {_FACETS} SELECT * FROM facets",
    "debounce_stream": f"WITH {_BURSTS} SELECT * FROM bursts",
    "search_stream": f"""WITH {_SEARCHES} SELECT user_id, q, ts, 'names' AS section, match_name, label FROM searched
JOIN names ON shard = {sql_shard('q')} AND starts_with(match_name, {sql_match_name('lower(q)')})""",
    "search_stream_counts": f"""WITH {_SEARCHES}
SELECT user_id, q, ts, count(label) AS n_matches, count(label) AS n_targets, count(label) = 0 AS no_match FROM searched
LEFT JOIN names ON shard = {sql_shard('q')} AND starts_with(match_name, {sql_match_name('lower(q)')}) GROUP BY user_id, q, ts, seq""",
    "changed_stream": f"WITH {_CHANGED} SELECT user_id, value, ts, seq FROM changed",
    "settings_stream": """WITH wm AS (SELECT make_timestamp(epoch_us(max(ts)) // 1000 * 1000) AS t FROM events),
ev AS (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events),
last AS (SELECT user_id AS scope_id, event_type AS key, CASE WHEN k > 0 THEN CAST(k AS VARCHAR) ELSE '' END AS value, k % 5 - 1 AS days, ts
  FROM ev QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1),
ops AS (SELECT *, CASE WHEN days < 0 THEN 'delete' WHEN days > 0 AND ts + to_days(CAST(days AS INTEGER)) <= t THEN 'expire' ELSE 'set' END AS op FROM last, wm)
SELECT scope_id, key, CASE WHEN op = 'set' THEN value END AS value, op FROM ops""",
    "toggle_stream": "SELECT CAST(user_id AS VARCHAR) AS id, count(*) % 2 = 1 AS is_open FROM events WHERE event_type = 'click' GROUP BY 1",
    "toggle_all_stream": f"""WITH {EVENTS_K},
rows AS (SELECT user_id AS page_id, event_type = 'signup' AS is_all, CAST(k AS VARCHAR) AS id, ts, event_id FROM ev WHERE event_type IN ('click', 'signup')),
whole AS (SELECT page_id, max((ts, event_id)) AS last_all, count(*) % 2 = 0 AS base FROM rows WHERE is_all GROUP BY 1)
SELECT page_id, NULL AS id, base AS is_open FROM whole
UNION ALL SELECT page_id, id, (coalesce(any_value(base), TRUE) <> (count(*) % 2 = 1)) FROM rows LEFT JOIN whole USING (page_id)
  WHERE NOT is_all AND (last_all IS NULL OR (ts, event_id) > last_all) GROUP BY 1, 2""",
    "facet_stream": f"WITH {_FACETS} SELECT * FROM facets",
}
