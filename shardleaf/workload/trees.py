"""Queries on path-encoded trees and toggles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tree as op
from .inputs import EVENTS_K, TREE, table, tree, with_k


def q_paths(spark, sf):
    listed = F.array_join("ancestors", "/").alias("ancestors")
    return op.tree_paths(tree(spark, sf)).select("id", "depth", "parent", listed)


def clicks(spark, sf):
    """Clicks of the event table: the user's number is the id of the clicked section."""
    ev = table(spark, sf, "events").where("event_type = 'click'")
    return ev.select(F.col("user_id").cast("string").alias("id"), "ts", F.col("event_id").alias("seq"))


def sections(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"))


def q_toggle_all(spark, sf):
    ev = with_k(table(spark, sf, "events")).select(
        F.col("user_id").alias("page_id"), F.col("k").cast("string").alias("id"), "ts", F.col("event_id").alias("seq"), "event_type"
    )
    return op.toggle_all_state(
        ev.select("page_id", "id").distinct(), ev.where("event_type = 'click'"), ev.where("event_type = 'signup'"), ["page_id"]
    )


QUERIES = {
    "tree_paths": q_paths,
    "level_filter": lambda s, sf: op.level_filter(tree(s, sf), 3),
    "tree_children": lambda s, sf: op.tree_children(op.tree_paths(tree(s, sf))),
    "tree_descendants": lambda s, sf: op.tree_descendants(op.tree_paths(tree(s, sf))),
    "subtree_rollup": lambda s, sf: op.subtree_rollup(tree(s, sf), ["cents"]),
    "toggle_state": lambda s, sf: op.toggle_state(sections(s, sf), clicks(s, sf)),
    "toggle_all_state": q_toggle_all,
}

SQL = {
    "tree_paths": f"WITH {TREE} SELECT id, depth, parent, array_to_string(ancestors, '/') AS ancestors FROM paths",
    "level_filter": f"WITH {TREE} SELECT id, CASE WHEN depth < 3 THEN 'open' ELSE 'closed' END AS state FROM paths WHERE depth <= 3",
    "tree_children": f"WITH {TREE} SELECT parent AS id, id AS child_id FROM paths WHERE parent IN (SELECT id FROM tree)",
    "tree_descendants": f"WITH {TREE} SELECT id, descendant_id FROM above WHERE id IN (SELECT id FROM tree)",
    "subtree_rollup": f"WITH {TREE} SELECT id, count(*) AS n_hidden, CAST(sum(cents) AS BIGINT) AS sum_cents FROM above WHERE id IN (SELECT id FROM tree) GROUP BY 1",
    "toggle_state": """WITH odd AS (SELECT CAST(user_id AS VARCHAR) AS id, count(*) % 2 = 1 AS odd FROM events WHERE event_type = 'click' GROUP BY 1)
SELECT CAST(c_custkey AS VARCHAR) AS id, coalesce(odd, FALSE) AS is_open FROM customer LEFT JOIN odd ON odd.id = CAST(c_custkey AS VARCHAR)""",
    "toggle_all_state": f"""WITH {EVENTS_K},
resets AS (SELECT user_id, max((ts, event_id)) AS last_reset, count(*) % 2 = 1 AS flipped FROM ev WHERE event_type = 'signup' GROUP BY 1),
odd AS (SELECT user_id, k, count(*) % 2 = 1 AS odd FROM ev LEFT JOIN resets USING (user_id)
  WHERE event_type = 'click' AND (last_reset IS NULL OR (ts, event_id) > last_reset) GROUP BY 1, 2),
blocks AS (SELECT DISTINCT user_id, k FROM ev)
SELECT user_id AS page_id, CAST(k AS VARCHAR) AS id, (coalesce(flipped, FALSE) = coalesce(odd, FALSE)) AS is_open
FROM blocks LEFT JOIN resets USING (user_id) LEFT JOIN odd USING (user_id, k)""",
}
