"""Streams over several batches against their batch forms and hand-written sequences."""

import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shardleaf import streaming as st
from shardleaf.operators import events as ev, settings as se, tree as tr
from shardleaf.plans import shared_dir
from shardleaf.sources import symbol_entries
from shardleaf.streaming.runs import as_local

from conftest import rows

T0 = datetime(2024, 1, 1)
DDL = "user_id string, value string, ts timestamp_ntz, seq long"


def files(spark, ddl, *batches):
    """One parquet file per batch, read one file at a time in this order."""
    path = shared_dir(spark, "stream-input")
    for data in batches:
        spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    for n, f in enumerate(sorted((os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")), key=os.path.getmtime)):
        os.utime(f, (1_700_000_000 + n, 1_700_000_000 + n))
    return st.read_events(spark, path, spark.read.parquet(path).schema, bytes_per_batch=1)


def typed(*events):
    return [(u, v, T0 + timedelta(seconds=s), n) for u, v, s, n in events]


BATCHES = (
    typed(("a", "g", 0, 0), ("a", "go", 0.2, 1), ("b", "x", 0.3, 2), ("a", "go", 5, 3)),
    typed(("a", "", 6, 4), ("a", "go", 6.1, 5), ("b", "x", 7, 6), ("b", "xy", 7.2, 7)),
    typed(("b", "late", 0.1, 8), ("c", "go", 9, 9), ("a", "gone", 8.9, 10), ("end", "", 60, 11)),
)


def test_debounce_equals_bursts_on_closed_data(spark):
    live = st.drain(st.debounce_stream(files(spark, DDL, *BATCHES)))
    whole = spark.createDataFrame([r for b in BATCHES for r in b if r[1] != "late"], DDL)
    closed = ev.settled_bursts(whole, ["user_id"], "value", ["ts", "seq"]).where("user_id <> 'end'")
    picked = ["user_id", "value", "had_reset"]
    assert rows(live.withColumn("ts", as_local(F.col("ts"))), *picked, "ts") == rows(closed, *picked, "ts")


def test_late_rows_within_the_delay_count(spark):
    live = st.drain(st.changed_stream(files(spark, DDL, *BATCHES), delay=30))
    whole = spark.createDataFrame([r for b in BATCHES for r in b], DDL)
    assert rows(live, "seq") == rows(ev.changed_only(whole.where("user_id <> 'end'"), ["user_id"], "value", ["ts", "seq"]), "seq")


def test_changed_values_come_in_order_over_batches(spark):
    live = st.drain(st.changed_stream(files(spark, DDL, *BATCHES)))
    assert rows(live, "user_id", "value", "seq") == [
        ("a", "g", 0), ("a", "go", 1), ("a", "go", 5), ("a", "gone", 10), ("b", "x", 2), ("b", "xy", 7), ("c", "go", 9)
    ]


def test_a_reset_flag_clears_the_memory(spark):
    ddl = DDL + ", escaped boolean"
    data = [(*r, r[3] == 1) for r in typed(("a", "x", 0, 0), ("a", "x", 1, 1), ("a", " x", 2, 2), ("a", "y", 3, 3), ("z", "", 9, 4))]
    live = st.drain(st.changed_stream(files(spark, ddl, data[:3], data[3:]), reset="escaped"))
    assert rows(live, "seq") == [(0,), (1,), (3,)]


def test_settled_queries_search_the_index(spark):
    names = spark.createDataFrame([("Go",), ("gone",), ("xy",), ("other",)], "label string")
    index = symbol_entries(names, "label", "label", F.lit(""), "names")
    found = st.search_stream(files(spark, DDL, *BATCHES), index)
    assert rows(found, "user_id", "q", "label") == [
        ("a", "go", "Go"), ("a", "go", "Go"), ("a", "go", "gone"), ("a", "go", "gone"),
        ("a", "gone", "gone"), ("b", "x", "xy"), ("b", "xy", "xy"), ("c", "go", "Go"), ("c", "go", "gone"),
    ]


def test_unchanged_queries_do_not_run_again_and_misses_are_told(spark):
    """`go` settles three times; the second time nothing has changed, before the third the field was emptied."""
    index = symbol_entries(spark.createDataFrame([("Go",), ("gone",)], "label string"), "label", "label", F.lit(""), "names")
    told = st.search_stream_counts(files(spark, DDL, *BATCHES), index)
    assert rows(told, "user_id", "q", "n_matches", "no_match") == [
        ("a", "go", 2, False), ("a", "go", 2, False), ("a", "gone", 1, False), ("b", "x", 0, True), ("b", "xy", 0, True), ("c", "go", 2, False),
    ]


def test_one_query_settles_and_remembers(spark):
    """Two stateful operators in one plan, no files between them; equal to the batch forms on all rows."""
    batches = [[r for r in b if r[1] != "late"] for b in BATCHES]
    whole = spark.createDataFrame([r for b in batches for r in b], DDL)
    bursts = ev.settled_bursts(whole, ["user_id"], "value", ["ts", "seq"])
    want = ev.changed_only(bursts, ["user_id"], "value", ["ts"], reset="had_reset")
    events, strike = st.with_clock(files(spark, DDL, *batches))
    live = st.drain(st.settled_queries(events), strike=strike)
    assert rows(live.withColumn("ts", as_local(F.col("ts"))), "user_id", "value", "ts") == rows(want, "user_id", "value", "ts")


def test_a_search_goes_on_after_a_stop(spark):
    """Stopped between batches with a burst open and a value remembered, and started again from its checkpoint."""
    index = symbol_entries(spark.createDataFrame([("Go",), ("gone",)], "label string"), "label", "label", F.lit(""), "names")
    first = typed(("a", "g", 0, 0), ("a", "go", 0.2, 1), ("b", "gon", 2, 2), ("tick", "", 2.1, 3))
    second = typed(("b", "gone", 2.3, 4), ("a", "go", 3, 5), ("tick", "", 5, 6))
    third = typed(("a", "go", 6, 7), ("a", "", 7, 8), ("a", "go", 7.2, 9), ("tick", "", 9, 10), ("a", "late", 1, 11), ("tick", "", 12, 12))
    path, target = shared_dir(spark, "typed"), shared_dir(spark, "searches")
    schema = spark.createDataFrame([], DDL).schema

    def run(data):
        spark.createDataFrame(data, DDL).coalesce(1).write.mode("append").parquet(path)
        query = st.start_search(st.read_events(spark, path, schema), index, target, counts=True, availableNow=True)
        query.awaitTermination()
        return query

    def told():
        return rows(spark.read.parquet(f"{target}/out"), "user_id", "q", "n_matches")

    run(first)
    assert told() == [("a", "go", 2)]  # b is still typing
    run(second)
    assert told() == [("a", "go", 2), ("b", "gone", 1)]  # b's burst went on over the stop; a's go is the same again
    late = run(third)
    assert told() == [("a", "go", 2), ("a", "go", 2), ("b", "gone", 1)]  # emptied inside a burst, so it runs again
    assert sum(st.late_rows(late).values()) == 1
    ids = {q for q in os.listdir(f"{target}/progress/state")}
    assert len(ids) == 2  # both operators keep their state under one checkpoint


def test_a_search_stopped_while_running(spark):
    """A query under a processing-time trigger is stopped after some batches; the rest comes after the restart, once."""
    index = symbol_entries(spark.createDataFrame([("word",)], "label string"), "label", "label", F.lit(""), "names")
    batches = [typed(*[(f"u{u}", f"word{b}" if b % 3 else "word", 10 * b, 100 * b + u) for u in range(3)]) for b in range(8)]
    live, target = files(spark, DDL, *batches), shared_dir(spark, "searches")
    query = st.start_search(live, index, target, counts=True, processingTime="0 seconds")
    for _ in range(600):
        if len([p for p in query.recentProgress if p.numInputRows]) >= 3:
            break
        time.sleep(0.1)
    query.stop()
    done = spark.read.parquet(f"{target}/out").count()
    st.start_search(live, index, target, counts=True, availableNow=True).awaitTermination()
    whole = st.drain(st.settled_queries(live))
    got = spark.read.parquet(f"{target}/out").withColumnRenamed("q", "value")
    assert rows(got, "user_id", "value", "ts") == rows(whole, "user_id", "value", "ts")
    assert done < got.count()


def test_facets_remember_over_batches(spark):
    def both(*events):
        return [(u, q, s, T0 + timedelta(seconds=t), n) for n, (u, q, s, t) in events]

    data = list(enumerate([("a", "x", None, 0), ("a", None, 2, 1), ("a", "y", None, 2), ("a", "", None, 3), ("a", None, 1, 4), ("b", None, 3, 0), ("b", "z", None, 5), ("e", "end", None, 9)]))
    ddl = "user_id string, q string, section_id int, ts timestamp_ntz, seq long"
    live = files(spark, ddl, both(*data[:2], data[5]), both(*data[2:5]), both(*data[6:]))
    found = st.drain(st.facet_stream(live.where("q is not null"), live.where("section_id is not null")))
    assert rows(found, "user_id", "q", "section_id", "seq") == [("a", "x", 0, 0), ("a", "x", 2, 1), ("a", "y", 2, 2), ("b", "z", 3, 6), ("e", "end", 0, 7)]


LOG = "scope_id int, key string, value string, days int, ts timestamp_ntz, seq long"


def test_settings_live(spark):
    def writes(*w):
        return [(s, k, v, d, T0 + timedelta(hours=h), n) for s, k, v, d, h, n in w]

    batches = (
        writes((1, "a", "one", 1, 0, 0), (1, "b", "keep", None, 0, 1), (2, "a", "s", 0, 1, 2), (3, "c", "gone", 1, 0, 3)),
        writes((1, "a", "two", 1, 10, 4), (2, "a", "", -1, 11, 5)),
        writes((9, "clock", "t", 0, 30, 6)),
        writes((9, "clock", "t", 0, 40, 7)),
    )
    ops = st.drain(st.settings_stream(files(spark, LOG, *batches)), "update")
    assert rows(ops.where("scope_id <> 9"), "batch_id", "scope_id", "key", "value", "op")[:6] == [
        (0, 1, "a", "one", "set"), (0, 1, "b", "keep", "set"), (0, 2, "a", "s", "set"), (0, 3, "c", "gone", "set"),
        (1, 1, "a", "two", "set"), (1, 2, "a", None, "delete"),
    ]
    ends = rows(ops.where("op = 'expire'"), "scope_id", "key")
    assert ends == [(1, "a"), (3, "c")]
    last = ops.groupBy("scope_id", "key").agg(F.max_by(F.struct("value", "op"), "batch_id").alias("w")).where("w.op = 'set'")
    whole = spark.createDataFrame([r for b in batches for r in b], LOG)
    asof = se.settings_asof(whole, F.lit(T0 + timedelta(hours=40)).cast("timestamp_ntz"))
    assert rows(last, "scope_id", "key", "w.value") == rows(asof)


def test_toggles_live(spark):
    data = [("a", T0), ("b", T0), ("a", T0), ("a", T0)]
    clicks = files(spark, "id string, ts timestamp_ntz", data[:2], data[2:])
    states = st.drain(st.toggle_stream(clicks), "update")
    assert rows(states, "batch_id", "id", "is_open") == [(0, "a", True), (0, "b", True), (1, "a", True)]


def test_toggle_all_live(spark):
    ddl = "page_id string, id string, is_all boolean, ts timestamp_ntz, seq long"

    def clicks(*c):
        return [(p, i, i is None, T0 + timedelta(seconds=s), n) for p, i, s, n in c]

    batches = (
        clicks(("p", "x", 0, 0), ("p", "y", 1, 1), ("q", "x", 1, 2)), clicks(("p", None, 2, 3), ("p", "x", 3, 4)),
        clicks(("p", "x", 4, 5), ("p", "y", 5, 6), ("end", "x", 50, 7)),
    )
    told = st.drain(st.toggle_all_stream(files(spark, ddl, *batches)))
    in_order = [tuple(r) for r in told.orderBy("batch_id", F.col("id").isNotNull(), "id").where("page_id = 'p'").select("id", "is_open").collect()]
    assert in_order[-2:] == [("x", False), ("y", True)] and (None, False) in in_order
    whole = spark.createDataFrame([r for b in batches for r in b], ddl)
    single = whole.where("not is_all")
    state = tr.toggle_all_state(single.select("page_id", "id").distinct(), single, whole.where("is_all"), ["page_id"])
    assert rows(state.where("page_id <> 'end'")) == [("p", "x", False), ("p", "y", True), ("q", "x", False)]


def test_a_struck_clock_closes_everything(spark):
    """What is open when the data ends comes out too: the streams equal their batch forms on all rows."""
    batches = [[r for r in b if r[1] != "late"] for b in BATCHES]
    whole = spark.createDataFrame([r for b in batches for r in b], DDL)
    events, strike = st.with_clock(files(spark, DDL, *batches))
    live = st.drain(st.debounce_stream(events), strike=strike)
    assert rows(live, "user_id", "value", "had_reset") == rows(ev.settled_bursts(whole, ["user_id"], "value", ["ts", "seq"]), "user_id", "value", "had_reset")
    events, strike = st.with_clock(files(spark, DDL, *batches))
    live = st.drain(st.changed_stream(events), strike=strike)
    assert rows(live, "user_id", "value", "seq") == rows(ev.changed_only(whole, ["user_id"], "value", ["ts", "seq"]), "user_id", "value", "seq")


def test_an_empty_stream(spark):
    live = files(spark, DDL, [])
    assert st.drain(st.debounce_stream(live)).count() == 0


def test_keys_are_handled_in_buckets(spark):
    """Python is called per bucket of keys, with their state: a call and a pandas frame per key cost more than its rows."""
    live = files(spark, DDL, *BATCHES)
    log = files(spark, LOG, [(1, "a", "one", 1, T0, 0)])
    both = live.select("user_id", F.col("value").alias("q"), "ts", "seq")
    choices = live.select("user_id", F.lit(1).alias("section_id"), "ts", "seq")
    clicks = live.select(F.col("user_id").alias("page_id"), F.col("value").alias("id"), F.lit(False).alias("is_all"), "ts", "seq")
    for stream in (st.settings_stream(log), st.facet_stream(both, choices), st.changed_stream(live), st.toggle_all_stream(clicks)):
        plan = stream._jdf.queryExecution().analyzed().toString()
        assert "FlatMapGroupsInPandasWithState" in plan and "pmod" in plan and "TransformWithState" not in plan


def test_settings_of_null_scopes_and_past_lifetimes(spark):
    """Null keys are one key, also beside long ones; a lifetime that ends before the watermark is set and expires at once."""
    big = 2**60 + 1
    ddl = LOG.replace("scope_id int", "scope_id long")

    def writes(*w):
        return [(s, "k", v, d, T0 + timedelta(hours=h), n) for s, v, d, h, n in w]

    batches = writes((None, "x", 0, 0, 0), (big, "y", 1, 1, 1)), writes((None, "", -1, 2, None), (big, "z", 1, 3, 3), (7, "end", 0, 100, 4)), writes((8, "late", 1, 101, 5), (8, "end", 0, 200, 6))
    ops = st.drain(st.settings_stream(files(spark, ddl, *batches), delay=10 * 3600), "update")
    got = [tuple(r) for r in ops.orderBy("batch_id", F.col("op") == "expire").select("scope_id", "value", "op").collect()]
    assert [g for g in got if g[0] is None] == [(None, "x", "set"), (None, None, "delete")]
    assert [g for g in got if g[0] == big] == [(big, "y", "set"), (big, "z", "set"), (big, None, "expire")]


def test_state_grows_and_shrinks_over_batches(spark):
    """Rows wait over several batches, come out once and in order, and a toggled page keeps its blocks."""
    data = [typed(*[("u", f"v{b}{n % 2}", 10 * b + n, 100 * b + n) for n in range(5)]) for b in range(4)]
    live = files(spark, DDL, *data, typed(("end", "x", 500, 999)))
    whole = spark.createDataFrame([r for b in data for r in b], DDL)
    got = st.drain(st.changed_stream(live, delay=25, buckets=1)).where("user_id = 'u'")  # one bucket: shared with another user
    assert rows(got, "seq") == rows(ev.changed_only(whole, ["user_id"], "value", ["ts", "seq"]), "seq")
    assert got.select("batch_id").distinct().count() > 1
