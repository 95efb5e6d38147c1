from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shardleaf.operators import nearest, settings as op
from shardleaf.sources import setting_log

from conftest import rows

T0 = datetime(2024, 1, 1, 12)
DDL = "scope_id int, key string, value string, days int, ts timestamp_ntz, seq long"


def log(spark, *writes):
    data = [(s, k, v, d, T0 + timedelta(hours=h), i) for i, (s, k, v, d, h) in enumerate(writes)]
    return setting_log(spark.createDataFrame(data, DDL), seq="seq")


def at(hours):
    return F.lit(T0 + timedelta(hours=hours)).cast("timestamp_ntz")


def test_expiry(spark):
    rows_ = op.setting_expiry(log(spark, (1, "a", "x", None, 0), (1, "b", "x", 0, 0), (1, "c", "x", -1, 0), (1, "d", "x", 2, 0))).collect()
    got = {r["key"]: (r["full_key"], r["kind"], r["expires_at"]) for r in rows_}
    assert got == {
        "a": ("site_a", "persistent", T0 + timedelta(days=3650)), "b": ("site_b", "session", None),
        "c": ("site_c", "delete", None), "d": ("site_d", "persistent", T0 + timedelta(days=2)),
    }


def test_as_of(spark):
    writes = log(
        spark, (1, "a", "old", 1, 0), (1, "a", "new", 1, 5), (1, "b", "x", None, 0), (1, "b", "", -1, 1), (1, "s", "live", 0, 0),
        (2, "a", "first", 1, 2), (2, "a", "tie", 1, 2), (3, "xa", "other", 1, 0),
    )
    assert rows(op.settings_asof(writes, at(4))) == [(1, "a", "old"), (1, "s", "live"), (2, "a", "tie"), (3, "xa", "other")]
    assert rows(op.settings_asof(writes, at(24))) == [(1, "a", "new"), (1, "s", "live"), (2, "a", "tie")]
    assert rows(op.settings_asof(writes, at(29))) == [(1, "s", "live")]


def test_defaults_and_fallbacks(spark):
    ddl = "scope_id int, key string, value string"
    keys = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a")], "scope_id int, key string")
    stored = spark.createDataFrame([(1, "a", "p"), (2, "a", ""), (3, "xa", "no")], ddl)
    session = spark.createDataFrame([(1, "a", "s"), (2, "a", "s")], ddl)
    assert rows(op.setting_default(keys, stored, "d")) == [(1, "a", "p"), (2, "a", ""), (3, "a", "d")]
    assert rows(op.setting_fallback(keys, stored, session, "d")) == [(1, "a", "p"), (2, "a", "s"), (3, "a", "d")]
    catalog = spark.createDataFrame([(0, "All"), (3, "Files")], "section_id int, label string")
    chosen = spark.createDataFrame([(1, "s", "Files"), (2, "s", "Gone"), (3, "s", None)], ddl)
    assert rows(op.chosen_section(chosen, catalog), "scope_id", "section_id") == [(1, 3), (2, 0), (3, 0)]


def test_nearest(spark):
    asked = spark.createDataFrame([("g", p) for p in (0, 3, 3, 5, 9)] + [("h", 1), (None, 2)], "g string, pos int")
    items = spark.createDataFrame([("g", i) for i in (1, 3, 8, 8)] + [(None, 1)], "g string, item_index int")
    expected = [("g", 0, 1, None), ("g", 3, 3, 3), ("g", 5, 8, 3), ("g", 9, None, 8), ("h", 1, None, None), (None, 2, None, 1)]
    for chunk in (1_000_000, 2, 1):
        assert rows(nearest.nearest_visible(asked, items, ["g"], chunk)) == sorted(expected, key=repr)


def test_nearest_with_far_apart_positions_in_one_hot_group(spark):
    at = [i * 1_000_003 for i in range(300)]
    asked = spark.createDataFrame([("g", p + 1) for p in at] + [("h", 5)], "g string, pos long")
    items = spark.createDataFrame([("g", p) for p in at[::3]] + [("h", 5)], "g string, item_index long")
    assert rows(nearest.nearest_visible(asked, items, ["g"], 40)) == rows(nearest.nearest_visible(asked, items, ["g"]))


def test_next_and_previous_over_chunk_borders(spark):
    visible = {2, 3, 11, 17}
    items = spark.createDataFrame([("g", i, i in visible) for i in range(20)], "g string, item_index int, visible boolean")
    brute = [("g", i, i in visible, min((v for v in visible if v >= i), default=None), max((v for v in visible if v <= i), default=None)) for i in range(20)]
    for chunk in (1_000_000, 4):
        assert rows(nearest.next_prev_visible(items, ["g"], max_rows=chunk)) == sorted(brute, key=repr)
