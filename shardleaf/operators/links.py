"""Links between pages: resolving, classifying, counting, tooltips, dangling links, redirects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.links import PAGE_RULES, compiles, link_kind, resolve, tip_key, url_query
from ..plans import broadcast_if_small, cut_lineage


def resolve_links(links: DataFrame, pages: DataFrame | None = None, base: str = "url") -> DataFrame:
    """Add `url`, the absolute form of href.

    Links that already carry their page's URL (extract_links(pages, keep=["url"])) need no join. Pages may
    name another base; sources.page_base makes a column of what they name.
    """
    if pages is None:
        return links.withColumn("url", resolve(F.col(base), F.col("href")))
    bases = pages.select("page_id", F.col(base).alias("_base"))
    return links.join(bases, "page_id").withColumn("url", resolve(F.col("_base"), F.col("href"))).drop("_base")


def page_url_queries(pages: DataFrame) -> DataFrame:
    """(page_id, query_text) from the text after `?` of each URL."""
    return pages.select("page_id", url_query(F.col("url")).alias("query_text"))


def classify_link(links: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame = PAGE_RULES, default: str | None = "other") -> DataFrame:
    """Add the kind of the first matching rule.

    Rules in code, (kind, pattern) in order, become one expression; narrow. Rules in a table, (priority, pattern,
    kind), are tried on each distinct href, which is a join on whether the pattern is found: the rules are broadcast
    after they were measured. Of the rules that match, the one with the least priority holds, of several with one
    priority the least kind. Rules of which a part is null and patterns that are none do not count: see rule_errors.
    """
    if not isinstance(rules, DataFrame):
        return links.withColumn("kind", link_kind(F.col("href"), rules, default))
    good = cut_lineage(rules.select("priority", "pattern", "kind").dropna().where(compiles(F.col("pattern"))).distinct())
    hrefs = links.select(F.col("href").alias("_href")).where("_href is not null").distinct()
    hits = hrefs.join(broadcast_if_small(good), F.rlike("_href", F.col("pattern")))
    kinds = hits.groupBy("_href").agg(F.min_by("kind", F.struct("priority", "kind")).alias("kind"))
    found = links.drop("kind").join(cut_lineage(kinds), F.col("href") == F.col("_href"), "left").drop("_href")
    return found.withColumn("kind", F.coalesce("kind", F.lit(default).cast("string")))


def rule_errors(rules: DataFrame) -> DataFrame:
    """Rules (priority, pattern, kind) that classify_link leaves out, with the reason in `error`."""
    reason = F.when(F.col("priority").isNull() | F.col("pattern").isNull() | F.col("kind").isNull(), "null").when(~compiles(F.col("pattern")), "not a pattern")
    return rules.select("priority", "pattern", "kind", reason.alias("error")).where("error is not null")


def link_multiplicity(links: DataFrame) -> DataFrame:
    """(href, n_links, in_degree): times listed, and distinct pages that list it.

    Counted per (href, page) first, so a popular href is combined on the map side twice.
    """
    per_page = links.groupBy("href", "page_id").agg(F.count(F.lit(1)).alias("n"))
    return per_page.groupBy("href").agg(
        F.sum("n").alias("n_links"), F.count("page_id").alias("in_degree")
    )


def distinct_links(links: DataFrame) -> DataFrame:
    return links.select("href").distinct()


def tooltip_join(links: DataFrame, defs: DataFrame, href: str = "href") -> DataFrame:
    """Add tip, the definition of the linked symbol; null if there is none.

    defs is (def_id, name, tip); of several definitions under one key the first (least def_id) holds.
    """
    first = (
        defs.select(tip_key(F.col("name")).alias("tip_key"), "def_id", "tip")
        .groupBy("tip_key")
        .agg(F.min_by("tip", F.struct("def_id", "tip")).alias("tip"))
    )
    return links.withColumn("tip_key", tip_key(F.col(href))).join(cut_lineage(first), "tip_key", "left")


def dangling_links(resolved: DataFrame, pages: DataFrame) -> DataFrame:
    """(page_id, href, url) of resolved links that no page answers. Fragments do not count."""
    bare = lambda c: F.regexp_replace(c, "#.*$", "")
    known = cut_lineage(pages.select(bare(F.col("url")).alias("_page")).distinct())
    links = resolved.select("page_id", "href", "url", bare(F.col("url")).alias("_page"))
    return links.join(known, "_page", "left_anti").drop("_page")


def resolve_redirects(redirects: DataFrame) -> DataFrame:
    """(src, final, hops, is_cycle) for every redirecting address (src, dst).

    Pointer doubling: each round joins the unfinished rows with the table itself and doubles the
    distance covered, so a chain of n hops takes about log2(n) rounds, without a hop limit. After
    k rounds every source within 2^k hops of its end is finished; if a round finishes no row, what
    is left runs into a cycle and gets no final address. Each round writes its unfinished rows to
    the shared folder.
    Of several targets of one source the least holds.
    """
    edges = redirects.where("src is not null and dst is not null").groupBy("src").agg(F.min("dst").alias("cur"))
    edges = cut_lineage(edges)
    sources = edges.select(F.col("src").alias("cur"), F.lit(True).alias("_more"))
    table = cut_lineage(edges.join(sources, "cur", "left").select(
        "src", "cur", F.lit(1).cast("long").alias("hops"), F.col("_more").isNull().alias("done")
    ))
    finished, active = table.where("done"), table.where("not done")
    left = active.count()
    while left:
        jump = finished.unionByName(active).select(
            F.col("src").alias("cur"), F.col("cur").alias("_cur"), F.col("hops").alias("_hops"), F.col("done").alias("_done")
        )
        table = cut_lineage(active.join(jump, "cur").select(
            "src", F.col("_cur").alias("cur"), (F.col("hops") + F.col("_hops")).alias("hops"), F.col("_done").alias("done")
        ))
        finished, active = finished.unionByName(table.where("done")), table.where("not done")
        before, left = left, active.count()
        if left == before:
            break
    state = finished.unionByName(active)
    return state.select(
        "src", F.when(F.col("done"), F.col("cur")).alias("final"), F.when(F.col("done"), F.col("hops")).alias("hops"),
        (~F.col("done")).alias("is_cycle"),
    )
