"""Every operator as a query over the given tables, with the SQL it must agree with."""

from . import events, links, search, settings, text, trees

PARTS = (search, links, text, trees, settings, events)


def queries():
    return {name: q for part in PARTS for name, q in part.QUERIES.items()}


def oracle_sql():
    return {name: sql for part in PARTS for name, sql in part.SQL.items()}
