"""Queries on settings and on positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import nearest, settings as op
from ..plans import numbered
from .inputs import EVENTS_K, LOG, log_of, table, with_k

AS_OF = "2024-01-20 00:00:00"


def log(spark, sf):
    return log_of(table(spark, sf, "events"))


def current(spark, sf):
    return op.settings_asof(log(spark, sf), F.lit(AS_OF).cast("timestamp_ntz"))


def wanted(spark, sf):
    """Every key that a user ever wrote, and one that every customer is asked for."""
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("scope_id"), F.lit("view").alias("key"))
    return customers.unionByName(log(spark, sf).select("scope_id", "key")).distinct()


def last_of(rows, kind):
    last = rows.where(F.col("kind") == kind).groupBy("scope_id", "key").agg(F.max(F.struct("ts", "seq", "value")).alias("w"))
    return last.select("scope_id", "key", "w.value")


def q_fallback(spark, sf):
    rows = op.setting_expiry(log(spark, sf))
    return op.setting_fallback(wanted(spark, sf), last_of(rows, "persistent"), last_of(rows, "session"), "none")


def q_chosen(spark, sf):
    customer = table(spark, sf, "customer")
    chosen = customer.select(F.col("c_custkey").alias("scope_id"), F.lit("section").alias("key"), F.col("c_mktsegment").alias("value"))
    labels = customer.where("c_mktsegment <> 'MACHINERY'").groupBy(F.col("c_mktsegment").alias("label")).agg(
        (F.min("c_custkey") + 1).alias("section_id")
    )
    return op.chosen_section(chosen, labels)


def q_nearest(spark, sf):
    ev = with_k(table(spark, sf, "events"))
    asked = ev.where("event_type = 'view'").select("user_id", F.col("k").alias("pos"))
    items = ev.where("event_type = 'purchase'").select("user_id", F.col("k").alias("item_index"))
    return nearest.nearest_visible(asked, items, ["user_id"]).fillna(-1, ["next", "prev"])


def q_next_prev(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", (F.col("event_type") == "click").alias("visible"))
    rows = numbered(ev, ["user_id"], ["ts", "event_id"], "item_index")
    return nearest.next_prev_visible(rows, ["user_id"]).drop("ts").fillna(-1, ["next_visible", "prev_visible"])


QUERIES = {
    "setting_log": log,
    "setting_expiry": lambda s, sf: op.setting_expiry(log(s, sf)),
    "settings_asof": current,
    "setting_default": lambda s, sf: op.setting_default(wanted(s, sf), current(s, sf), "none"),
    "chosen_section": q_chosen,
    "setting_fallback": q_fallback,
    "nearest_visible": q_nearest,
    "next_prev_visible": q_next_prev,
}

_CURRENT = f"""{LOG},
last AS (SELECT * FROM expiry WHERE ts <= TIMESTAMP '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY scope_id, key ORDER BY ts DESC, seq DESC) = 1),
current_values AS (SELECT scope_id, key, value FROM last WHERE kind = 'session' OR expires_at > TIMESTAMP '{AS_OF}')"""

_WANTED = """
wanted AS (SELECT c_custkey AS scope_id, 'view' AS key FROM customer UNION SELECT scope_id, key FROM log)"""

SQL = {
    "setting_log": f"WITH {LOG} SELECT * FROM log",
    "setting_expiry": f"WITH {LOG} SELECT * FROM expiry",
    "settings_asof": f"WITH {_CURRENT} SELECT * FROM current_values",
    "setting_default": f"""WITH {_CURRENT},{_WANTED}
SELECT scope_id, key, coalesce(value, 'none') AS value FROM wanted LEFT JOIN current_values USING (scope_id, key)""",
    "chosen_section": """WITH labels AS (SELECT c_mktsegment AS value, min(c_custkey) + 1 AS section_id FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1)
SELECT c_custkey AS scope_id, 'section' AS key, c_mktsegment AS value, coalesce(section_id, 0) AS section_id
FROM customer LEFT JOIN labels ON value = c_mktsegment""",
    "setting_fallback": f"""WITH {LOG},{_WANTED},
v AS (SELECT scope_id, key, kind, arg_max(value, (ts, seq)) AS value FROM expiry GROUP BY 1, 2, 3)
SELECT w.scope_id, w.key, coalesce(nullif(p.value, ''), nullif(s.value, ''), 'none') AS value FROM wanted w
LEFT JOIN v p ON p.scope_id = w.scope_id AND p.key = w.key AND p.kind = 'persistent'
LEFT JOIN v s ON s.scope_id = w.scope_id AND s.key = w.key AND s.kind = 'session'""",
    "nearest_visible": f"""WITH {EVENTS_K},
asked AS (SELECT DISTINCT user_id, CAST(k AS BIGINT) AS pos FROM ev WHERE event_type = 'view'),
items AS (SELECT DISTINCT user_id, CAST(k AS BIGINT) AS i FROM ev WHERE event_type = 'purchase')
SELECT a.user_id, pos, coalesce(min(i) FILTER (i >= pos), -1) AS next, coalesce(max(i) FILTER (i <= pos), -1) AS prev
FROM asked a LEFT JOIN items USING (user_id) GROUP BY 1, 2""",
    "next_prev_visible": """WITH items AS (SELECT event_id, user_id, event_type = 'click' AS visible,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS item_index FROM events)
SELECT *, coalesce(min(CASE WHEN visible THEN item_index END) OVER (PARTITION BY user_id ORDER BY item_index ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), -1) AS next_visible,
  coalesce(max(CASE WHEN visible THEN item_index END) OVER (PARTITION BY user_id ORDER BY item_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS prev_visible FROM items""",
}
