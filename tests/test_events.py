import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shardleaf.operators import events as op
from shardleaf.plans import last_known, neighbours, numbered
from shardleaf.plans.ordered import split_groups

from conftest import rows

T0 = datetime(2024, 1, 1)
ORDER = ["ts", "seq"]


def typed(spark, *events):
    """(user, seconds, value) in order."""
    data = [(u, v, T0 + timedelta(seconds=s), i) for i, (u, s, v) in enumerate(events)]
    return spark.createDataFrame(data, "user_id string, value string, ts timestamp_ntz, seq long")


def test_debounce_at_exactly_the_gap(spark):
    ev = typed(spark, ("a", 0, "x"), ("a", 0.4, "xy"), ("a", 0.9, "xyz"), ("a", 1.3, "q"), ("b", 0.1, "z"))
    assert rows(op.debounce_batch(ev, ["user_id"], ORDER), "value") == [("q",), ("xy",), ("z",)]


def test_changes_are_squeezed_and_reset_by_empty(spark):
    ev = typed(spark, ("a", 0, "x"), ("a", 1, " x "), ("a", 2, "x y"), ("a", 3, "xy"), ("a", 4, ""), ("a", 5, "xy"), ("a", 6, None), ("a", 7, " "), ("b", 0, ""))
    assert rows(op.changed_only(ev, ["user_id"], "value", ORDER), "seq") == [(0,), (2,), (5,)]
    flagged = ev.where("value = 'x' or value = ' x '").withColumn("escaped", F.col("seq") == 1)
    assert rows(op.changed_only(flagged, ["user_id"], "value", ORDER, reset="escaped"), "seq") == [(0,), (1,)]


def test_an_unchanged_last_event_cancels_the_pending_search(spark):
    ev = typed(spark, ("a", 0, "go"), ("a", 10, "gone"), ("a", 10.2, "go"), ("a", 20, "gone"), ("a", 30, "go"), ("a", 30.1, ""), ("a", 30.2, "gone"))
    settled = op.settled_bursts(ev, ["user_id"], "value", ORDER)
    assert rows(settled, "value", "had_reset") == [("go", False), ("go", False), ("gone", False), ("gone", True)]
    searched = op.changed_only(settled, ["user_id"], "value", ["ts"], reset="had_reset")
    seconds = sorted((r["ts"] - T0).total_seconds() for r in searched.collect())
    assert seconds == [0, 20, 30.2]


def test_facets(spark):
    data = [("a", "x", None, 0), ("a", None, 2, 1), ("a", "y", None, 2), ("a", "", None, 3), ("a", None, 1, 4), ("b", None, 3, 0), ("b", "z", None, 1)]
    ev = spark.createDataFrame(data, "user_id string, q string, section_id int, ts int")
    assert rows(op.facet_batch(ev, ["user_id"], ["ts"])) == [("a", "x", 0, 0), ("a", "x", 2, 1), ("a", "y", 2, 2), ("b", "z", 3, 1)]


def skewed(spark, n=600):
    """One user holds most rows, one key is null, many instants are shared."""
    rnd = random.Random(3)
    users = ["hot"] * 5 + ["a", "b", None]
    data = [(rnd.choice(users), rnd.choice(["x", "y", "", "x y", None]), T0 + timedelta(seconds=rnd.randrange(400) / 2), i) for i in range(n)]
    return spark.createDataFrame(data, "user_id string, value string, ts timestamp_ntz, seq long")


def test_hot_groups_are_split_evenly(spark):
    chunked, split = split_groups(skewed(spark), ["user_id"], ORDER, 50)
    sizes = [r["count"] for r in chunked.groupBy("user_id", "_chunk").count().collect()]
    assert split and sum(sizes) == 600 and max(sizes) < 150
    assert not split_groups(skewed(spark), ["user_id"], ORDER, 600)[1]


def test_split_groups_give_the_same_rows(spark):
    ev, keys = skewed(spark), ["user_id"]
    jobs = [
        lambda m: numbered(ev, keys, ORDER, "n", m),
        lambda m: neighbours(ev, keys, ORDER, {"v": F.col("value"), "s": F.col("seq")}, "before", "after", m),
        lambda m: last_known(ev.withColumn("value", F.when(F.col("seq") % 97 == 0, F.col("value"))), keys, ORDER, ["value"], m),
        lambda m: op.changed_only(ev, keys, "value", ORDER, max_rows=m),
        lambda m: op.debounce_batch(ev, keys, ORDER, 0.75, max_rows=m),
        lambda m: op.settled_bursts(ev, keys, "value", ORDER, 0.75, max_rows=m),
        lambda m: op.facet_batch(
            ev.select("user_id", F.when(F.col("seq") % 5 == 0, F.col("value")).alias("q"),
                      F.when(F.col("seq") % 41 == 1, F.col("seq").cast("int")).alias("section_id"), "ts", "seq"), keys, ORDER, max_rows=m),
    ]
    for job in jobs:
        assert rows(job(40)) == rows(job(None))


def test_numbering_copies(spark):
    copies = spark.range(500).select(F.lit("k").alias("k"), F.lit(1).alias("v"))
    assert rows(numbered(copies, ["k"], ["v"], "n", 60), "n") == sorted(((i,) for i in range(500)), key=repr)


def test_neighbours_see_one_order_whether_split_or_not(spark):
    """400 rows, 20 to a position: every row but the last has a successor of its own, whichever plan runs."""
    from shardleaf.plans import last_known, neighbours, numbered

    df = spark.createDataFrame([("k", i // 20, i) for i in range(400)], "k string, pos int, id int")
    plain, split = (rows(neighbours(df, ["k"], ["pos"], {"id": F.col("id")}, before="b", after="a", max_rows=n), "id", "b.id", "a.id") for n in (None, 40))
    assert plain == split and len({a for _, _, a in plain}) == 400
    assert rows(numbered(df, ["k"], ["pos"], "n", 40)) == rows(numbered(df, ["k"], ["pos"], "n"))
    holes = df.withColumn("v", F.when(F.col("id") % 7 == 0, F.col("id")))
    assert rows(last_known(holes, ["k"], ["pos"], ["v"], 40)) == rows(last_known(holes, ["k"], ["pos"], ["v"]))
