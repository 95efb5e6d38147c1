"""Expressions on path ids such as row_0_1_."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def depth(row_id: Column) -> Column:
    """Number of path parts: the underscores but one."""
    return F.length(row_id) - F.length(F.replace(row_id, F.lit("_"), F.lit(""))) - 1


def parent(row_id: Column) -> Column:
    """Id one level up; null on the top level."""
    return F.when(depth(row_id) > 1, F.regexp_replace(row_id, r"[0-9]+_$", ""))


def at_level(row_id: Column, level: Column) -> Column:
    """Id of the row's ancestor on a level, counted from 1."""
    return F.concat(F.call_function("substring_index", row_id, F.lit("_"), level + 1), F.lit("_"))


def levels_above(row_id: Column) -> Column:
    """Levels of the row's ancestors, top first."""
    return F.when(depth(row_id) > 1, F.sequence(F.lit(1), depth(row_id) - 1)).otherwise(F.array().cast("array<int>"))


def ancestors(row_id: Column) -> Column:
    """Ids of all levels above, top first."""
    return F.transform(levels_above(row_id), lambda level: at_level(row_id, level))


def path_order(row_id: Column) -> Column:
    """Sort key in page order: the parts as numbers, so that 2 comes before 10."""
    return F.transform(F.regexp_extract_all(row_id, F.lit("([0-9]+)"), F.lit(1)), lambda p: p.cast("long"))
