"""Settings with a lifetime: expiry, state at a time, defaults and fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..plans import broadcast_if_small, cut_lineage

DEFAULT_DAYS = 3650
NAMESPACE = "site_"


def kind(days: Column) -> Column:
    return F.when(days == 0, "session").when(days < 0, "delete").otherwise("persistent")


def setting_expiry(log: DataFrame, namespace: str = NAMESPACE, default_days: int = DEFAULT_DAYS) -> DataFrame:
    """Add full_key, kind (session, delete, persistent) and expires_at (persistent ones only)."""
    days = F.coalesce(F.col("days"), F.lit(default_days))
    return log.withColumns({
        "full_key": F.concat(F.lit(namespace), F.col("key")),
        "kind": kind(days),
        "expires_at": F.when(days > 0, F.col("ts") + F.make_dt_interval(days)),
    })


def settings_asof(log: DataFrame, t: Column) -> DataFrame:
    """(scope_id, key, value) alive at time t: the last write of each key, unless deleted or expired."""
    last = (
        log.where(F.col("ts") <= t)
        .groupBy("scope_id", "key")
        .agg(F.max(F.struct("ts", "seq", "value", "days")).alias("w"))
        .select("scope_id", "key", "w.value", "w.days", "w.ts")
    )
    rows = setting_expiry(last)
    alive = (F.col("kind") == "session") | (F.col("expires_at") > t)
    return rows.where(alive).select("scope_id", "key", "value")


def setting_default(keys: DataFrame, settings: DataFrame, default: Column | str) -> DataFrame:
    """(scope_id, key, value): the value if set, else the default. The whole key has to match."""
    default = F.lit(default) if isinstance(default, str) else default
    return keys.select("scope_id", "key").join(settings, ["scope_id", "key"], "left").select(
        "scope_id", "key", F.coalesce("value", default).alias("value")
    )


def chosen_section(settings: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add section_id of the section whose label is the setting's value; 0 for an unknown label."""
    known = catalog.groupBy(F.col("label").alias("value")).agg(F.min("section_id").alias("section_id"))
    return settings.join(broadcast_if_small(cut_lineage(known)), "value", "left").withColumn("section_id", F.coalesce("section_id", F.lit(0)))


def setting_fallback(keys: DataFrame, persistent: DataFrame, session: DataFrame, default: str) -> DataFrame:
    """(scope_id, key, value): persistent value, else session value, else default; empty is unset."""
    on = ["scope_id", "key"]
    p = persistent.select(*on, F.nullif(F.col("value"), F.lit("")).alias("_p"))
    s = session.select(*on, F.nullif(F.col("value"), F.lit("")).alias("_s"))
    return keys.select(*on).join(p, on, "left").join(s, on, "left").select(
        *on, F.coalesce("_p", "_s", F.lit(default)).alias("value")
    )
