"""Queries on links, page metadata and redirects."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import links as op
from ..plans import neighbours
from ..sources import page_meta
from .inputs import LINKS, RESOLVED, TITLES, links, resolved, table

# Kinds for the word links of the given pages: first match wins.
WORD_RULES = (("marked", r"[.,]$"), ("accented", r"[^\x00-\x7F]"), ("capital", "^/[A-Z]"), ("word", "^/[a-z]+$"))


def rule_table(spark, sf):
    """The word rules behind one rule per nation: words with its first four letters in turn. One pattern is broken."""
    letters = F.regexp_replace(F.lower(F.substring("n_name", 1, 4)), "(.)", "$1.*")
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("priority"), F.concat(F.lit("^/"), letters).alias("pattern"), F.col("n_name").alias("kind"))
    words = [(1000 + i, pattern, kind) for i, (kind, pattern) in enumerate(WORD_RULES)] + [(-1, "[broken", "broken")]
    return nations.unionByName(spark.createDataFrame(words, "priority int, pattern string, kind string"))


def q_rules(spark, sf):
    return op.classify_link(links(spark, sf).select("page_id", "pos", "href"), rule_table(spark, sf))


def known_pages(spark, sf):
    """Pages, and the last link of each page, taken as alive."""
    last = resolved(spark, sf).groupBy("page_id").agg(F.max_by("url", "pos").alias("url"))
    return table(spark, sf, "pages").select("url").unionByName(last.select("url"))


def first_redirects(spark, sf):
    """Redirects among the pages' words: each link of a page leads to the next one there."""
    rows = neighbours(links(spark, sf), ["page_id"], ["pos"], {"href": F.col("href")}, after="next")
    return rows.select(F.col("href").alias("src"), F.col("next.href").alias("dst"))


def q_redirects(spark, sf):
    found = op.resolve_redirects(first_redirects(spark, sf))
    return found.withColumn("hops", F.coalesce("hops", F.lit(-1)))


def definitions(spark, sf):
    """Each document defines its first word."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("def_id"), F.regexp_extract("text", r"^\S+", 0).alias("name"),
        F.concat("lang", F.lit("/"), "source").alias("tip"),
    )


def q_resolve(spark, sf):
    pages = table(spark, sf, "pages")
    return op.resolve_links(links(spark, sf).drop("page_url"), pages).select("page_id", "pos", "href", "url")


QUERIES = {
    "extract_links": lambda s, sf: links(s, sf).drop("page_url"),
    "page_meta": lambda s, sf: page_meta(table(s, sf, "pages")),
    "resolve_links": q_resolve,
    "page_url_queries": lambda s, sf: op.page_url_queries(table(s, sf, "pages")),
    "classify_link": lambda s, sf: op.classify_link(links(s, sf).select("page_id", "pos", "href"), WORD_RULES),
    "classify_by_table": q_rules,
    "link_multiplicity": lambda s, sf: op.link_multiplicity(links(s, sf)),
    "distinct_links": lambda s, sf: op.distinct_links(links(s, sf)),
    "tooltip_join": lambda s, sf: op.tooltip_join(links(s, sf).select("page_id", "pos", "href"), definitions(s, sf)),
    "dangling_links": lambda s, sf: op.dangling_links(resolved(s, sf), known_pages(s, sf)),
    "resolve_redirects": q_redirects,
}

SQL = {
    "extract_links": f"WITH {LINKS} SELECT page_id, pos, href, anchor FROM links",
    "page_meta": f"WITH {TITLES} SELECT page_id, title, lang, charset, generator, refresh_url FROM metas",
    "resolve_links": f"WITH {LINKS},{RESOLVED} SELECT page_id, pos, href, url FROM resolved",
    "page_url_queries": "SELECT page_id, nullif(url_decode(replace(regexp_extract(url, '\\?([^#]*)', 1), '+', '%2B')), '') AS query_text FROM pages",
    "classify_link": rf"""WITH {LINKS} SELECT page_id, pos, href, CASE WHEN regexp_matches(href, '[.,]$') THEN 'marked'
  WHEN regexp_matches(href, '[^\x00-\x7F]') THEN 'accented' WHEN regexp_matches(href, '^/[A-Z]') THEN 'capital'
  WHEN regexp_matches(href, '^/[a-z]+$') THEN 'word' ELSE 'other' END AS kind FROM links""",
    "classify_by_table": rf"""WITH {LINKS},
rules AS (SELECT n_nationkey AS priority, '^/' || regexp_replace(lower(substr(n_name, 1, 4)), '(.)', '\1.*', 'g') AS pattern, n_name AS kind FROM nation
  UNION ALL VALUES (1000, '[.,]$', 'marked'), (1001, '[^\x00-\x7F]', 'accented'), (1002, '^/[A-Z]', 'capital'), (1003, '^/[a-z]+$', 'word')),
kinds AS (SELECT href, arg_min(kind, (priority, kind)) AS kind FROM (SELECT DISTINCT href FROM links), rules WHERE regexp_matches(href, pattern) GROUP BY 1)
SELECT page_id, pos, href, coalesce(kind, 'other') AS kind FROM links LEFT JOIN kinds USING (href)""",
    "link_multiplicity": f"WITH {LINKS} SELECT href, count(*) AS n_links, count(DISTINCT page_id) AS in_degree FROM links GROUP BY 1",
    "distinct_links": f"WITH {LINKS} SELECT DISTINCT href FROM links",
    "tooltip_join": rf"""WITH {LINKS},
defs AS (SELECT '#a' || regexp_replace(regexp_extract(text, '^\S+'), '[^a-z_A-Z0-9]', '_', 'g') AS tip_key, doc_id, lang || '/' || source AS tip FROM documents),
first_def AS (SELECT tip_key, arg_min(tip, doc_id) AS tip FROM defs GROUP BY 1),
uses AS (SELECT page_id, pos, href, '#a' || regexp_replace(regexp_replace(href, '^.*/', ''), '[^a-z_A-Z0-9]', '_', 'g') AS tip_key FROM links)
SELECT page_id, pos, href, tip_key, tip FROM uses LEFT JOIN first_def USING (tip_key)""",
    "dangling_links": f"""WITH {LINKS},{RESOLVED},
known AS (SELECT regexp_replace(url, '#.*$', '') AS url FROM pages UNION SELECT arg_max(url, pos) FROM resolved GROUP BY page_id)
SELECT page_id, href, url FROM resolved WHERE url NOT IN (SELECT url FROM known)""",
    "resolve_redirects": f"""WITH RECURSIVE {LINKS},
two AS (SELECT href AS src, lead(href) OVER (PARTITION BY page_id ORDER BY pos) AS dst FROM links),
e AS (SELECT src, min(dst) AS dst FROM two WHERE dst IS NOT NULL GROUP BY 1),
w AS (SELECT src, dst AS cur, CAST(1 AS BIGINT) AS hops, [src, dst] AS path, src = dst AS is_cycle FROM e
  UNION ALL SELECT w.src, e.dst, hops + 1, list_append(path, e.dst), list_contains(path, e.dst)
  FROM w JOIN e ON e.src = w.cur WHERE NOT is_cycle)
SELECT src, CASE WHEN NOT is_cycle THEN cur END AS final, CASE WHEN NOT is_cycle THEN hops ELSE -1 END AS hops, is_cycle
FROM w WHERE is_cycle OR cur NOT IN (SELECT src FROM e)""",
}
