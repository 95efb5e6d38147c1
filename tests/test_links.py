import pytest
from pyspark.sql import functions as F

from shardleaf.functions.links import resolve
from shardleaf.operators import links as op
from shardleaf.plans import bounds
from shardleaf.sources import extract_links, page_base, page_meta

from conftest import rows

BASE = "https://h.org/a/b?x=1#top"


@pytest.mark.parametrize("href, url", [
    ("http://o.org/z", "http://o.org/z"), ("//o.org/z", "https://o.org/z"), ("/z", "https://h.org/z"), ("./z", "https://h.org/a/z"),
    ("z?q#f", "https://h.org/a/z?q#f"), ("../z", "https://h.org/z"), ("../../../z/./y/", "https://h.org/z/y/"), ("?q", "https://h.org/a/b?q"),
    ("#f", "https://h.org/a/b?x=1#f"), ("", "https://h.org/a/b?x=1"), ("..", "https://h.org/"), ("mailto:me@h.org", "mailto:me@h.org"),
])
def test_resolve(spark, href, url):
    df = spark.createDataFrame([(BASE, href)], "base string, href string")
    assert df.select(resolve(F.col("base"), F.col("href"))).first()[0] == url


def test_resolve_on_a_bare_host(spark):
    df = spark.createDataFrame([("https://h.org", "./Home.html")], "base string, href string")
    assert df.select(resolve(F.col("base"), F.col("href"))).first()[0] == "https://h.org/Home.html"


def test_both_ways_to_resolve_agree(spark):
    pages = spark.createDataFrame([(1, "https://h.org/a/", '<a href="x">X</a><a href="/y">Y</a>')], "page_id int, url string, html string")
    joined = op.resolve_links(extract_links(pages), pages)
    kept = op.resolve_links(extract_links(pages.withColumnRenamed("url", "page_url"), keep=["page_url"]), base="page_url")
    assert rows(joined, "pos", "url") == rows(kept, "pos", "url") == [(0, "https://h.org/a/x"), (1, "https://h.org/y")]


def test_extract_links(spark):
    html = (
        "<!-- <a href='no'>no</a> --><script>'<a href=no>'</script><a name='n'>anchor</a>"
        '<a href="x.html"/><a class=c HREF = \'y.html\'><b>Y</b> &amp; y</a><A href=z.html>Z<a href="?a=1&amp;b=2">q</a><abbr>no</abbr>'
    )
    pages = spark.createDataFrame([(7, html), (8, "none")], "page_id int, html string")
    assert rows(extract_links(pages)) == [
        (7, 0, "x.html", ""), (7, 1, "y.html", "Y & y"), (7, 2, "z.html", "Z"), (7, 3, "?a=1&b=2", "q")
    ]


@pytest.mark.parametrize("html, links", [
    ('<a title="a>b" href="/w">W</a>', [("/w", "W")]), ("<a href=/foo/>Foo</a>", [("/foo/", "Foo")]), ("<a data-href=no>x</a>", []),
    ("<a title='href=no' href=yes>x</a>", [("yes", "x")]), ("<a title=it's href='u v'>t</a>", [("u v", "t")]), ('<a href="" >e</a>', [("", "e")]),
    ('<a href="x.html"/><a href=y.html />z', [("x.html", ""), ("y.html", "")]), ("a<script><a href=no>x</a>", []), ('<a href="?a&copy=1&lt;">q</a>', [("?a&copy=1<", "q")]),
])
def test_links_as_browsers_read_them(spark, html, links):
    found = extract_links(spark.createDataFrame([(1, html)], "page_id int, html string"))
    assert [(r.href, r.anchor) for r in found.orderBy("pos").collect()] == links


def test_a_page_may_name_its_base(spark):
    data = [(1, "https://h.org/a/", "<base target=x href='https://cdn.org/x/'><a href=y>Y</a><a href=' /z\n'>Z</a>"), (2, "https://h.org/b/", "<base href=sub/><a href=y>Y</a>"), (3, "https://h.org/c/", "<a href=y>Y</a>")]
    pages = page_base(spark.createDataFrame(data, "page_id int, page_url string, html string"), "page_url")
    found = op.resolve_links(extract_links(pages, keep=["base_url"]), base="base_url")
    assert rows(found, "page_id", "url") == [(1, "https://cdn.org/x/y"), (1, "https://cdn.org/z"), (2, "https://h.org/b/sub/y"), (3, "https://h.org/c/y")]


def test_page_meta(spark):
    redirect = (
        '<html lang="pt"><title>Moved away</title><meta charset=ISO-8859-15>'
        '<meta content="3;URL=\'next/start.htm\'" http-equiv=Refresh><script>document.title = "<title>no</title>"</script></html>'
    )
    listing = (
        '<html data-x="a>b" lang="nl-BE"><head><title dir=ltr>Tea &amp; cake</title>'
        '<meta content="text/html; charset=koi8-r" http-equiv="content-type"><meta title="name=x" name=generator content="Loom > 2"></head></html>'
    )
    pages = spark.createDataFrame([(1, redirect), (2, listing), (3, "plain")], "page_id int, html string")
    assert rows(page_meta(pages)) == [
        (1, "Moved away", "pt", "ISO-8859-15", None, "next/start.htm"),
        (2, "Tea & cake", "nl-BE", "koi8-r", "Loom > 2", None),
        (3, None, None, None, None, None),
    ]


def test_counts_of_a_link_list(spark):
    """A crawl list of 102 links, 54 distinct, 9 of them repeated as often as here."""
    repeated = {
        "namespacemembers.html": 3, "namespacemembers_func.html": 3, "functions.html": 16, "functions_func.html": 15,
        "functions_vars.html": 4, "globals.html": 6, "globals_func.html": 5, "globals_vars.html": 3, "globals_enum.html": 2,
    }
    hrefs = [f"page_{i}.html" for i in range(45)] + [h for h, n in repeated.items() for _ in range(n)]
    html = "".join(f'<a href="{h}"/>\n' for h in hrefs)
    links = extract_links(spark.createDataFrame([(1, html)], "page_id int, html string"))
    counted = {r["href"]: (r["n_links"], r["in_degree"]) for r in op.link_multiplicity(links).collect()}
    assert (links.count(), op.distinct_links(links).count(), sum(n > 1 for n, _ in counted.values())) == (102, 54, 9)
    assert {h: counted[h] for h in repeated} == {h: (n, 1) for h, n in repeated.items()}


@pytest.mark.parametrize("href, kind", [
    ("kite_8cc_source.html", "source"), ("kite_8h.html", "file"), ("class_kite.html", "class"), ("class_kite-members.html", "members"),
    ("structtail__t.html", "struct"), ("namespace_wind.html", "namespace"), ("functions_k.html", "index"), ("annotated.html", "index"), ("about.html", "other"),
])
def test_link_kinds(spark, href, kind):
    assert op.classify_link(spark.createDataFrame([(href,)], "href string")).first()["kind"] == kind


def test_rules_from_a_table(spark):
    """Equal to the same rules in code; priorities, ties, nulls, broken patterns, repeated and null links."""
    hrefs = ["kite_8cc_source.html", "kite_8h.html", "class_kite.html", "class_kite-members.html", "structtail__t.html", "about.html", "", None, "about.html"]
    links = spark.createDataFrame([(i, h, "old") for i, h in enumerate(hrefs)], "pos int, href string, kind string")
    table = spark.createDataFrame([(i, p, k) for i, (k, p) in enumerate(op.PAGE_RULES)], "priority int, pattern string, kind string")
    assert rows(op.classify_link(links, table)) == rows(op.classify_link(links))
    assert op.rule_errors(table).count() == 0
    more = spark.createDataFrame(
        [(-5, "(", "no pattern"), (-4, None, "null"), (None, "a", "null"), (-3, "^about", "b"), (-3, "about", "a"), (-3, "*x", "no pattern"), (99, "", "any")], "priority int, pattern string, kind string"
    )
    kinds = {r.pos: r.kind for r in op.classify_link(links, table.union(more), None).collect()}
    assert (kinds[0], kinds[5], kinds[6], kinds[7], kinds[8]) == ("source", "a", "any", None, "a")
    assert rows(op.rule_errors(more), "error", "priority") == [("not a pattern", -3), ("not a pattern", -5), ("null", -4), ("null", None)]


def test_many_rules_without_a_broadcast(spark):
    links = spark.createDataFrame([(f"p{i}x",) for i in range(300)], "href string")
    table = spark.range(400).selectExpr("id AS priority", "concat('^p', id, 'x$') AS pattern", "concat('k', id) AS kind")
    keep = bounds.MAX_ROWS
    try:
        bounds.broadcast_if_small.__defaults__ = (10, bounds.MAX_BYTES)
        assert rows(op.classify_link(links, table), "href", "kind") == sorted((f"p{i}x", f"k{i}") for i in range(300))
    finally:
        bounds.broadcast_if_small.__defaults__ = (keep, bounds.MAX_BYTES)


def test_url_queries(spark):
    pages = spark.createDataFrame(
        [(1, "http://h/a?b%20c+d"), (2, "http://h/a#x?y"), (3, "http://h/a?"), (4, "http://h/?100%"), (5, "http://h/?a=1&b=%C3%A9#f")],
        "page_id int, url string",
    )
    assert rows(op.page_url_queries(pages)) == [(1, "b c+d"), (2, None), (3, None), (4, "100%"), (5, "a=1&b=é")]


def test_tooltips(spark):
    uses = spark.createDataFrame([("../x/a.html#1-b",), ("c.html",), ("none",)], "href string")
    defs = spark.createDataFrame([(2, "a.html#1-b", "second"), (1, "a_html_1_b", "first"), (3, "c.html", "c")], "def_id int, name string, tip string")
    assert rows(op.tooltip_join(uses, defs), "href", "tip_key", "tip") == [
        ("../x/a.html#1-b", "#aa_html_1_b", "first"), ("c.html", "#ac_html", "c"), ("none", "#anone", None)
    ]


def test_dangling(spark):
    links = spark.createDataFrame([(1, "a", "u/a"), (1, "b#x", "u/b#x"), (1, "c", "u/c"), (1, "n", None)], "page_id int, href string, url string")
    pages = spark.createDataFrame([("u/a#frag",), ("u/b",)], "url string")
    assert rows(op.dangling_links(links, pages), "href") == [("c",), ("n",)]


def test_redirects(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(130)]
    data = chain + [("a", "b"), ("b", "c"), ("s", "s"), ("x", "y"), ("y", "z"), ("z", "x"), ("into", "x"), ("two", "q"), ("two", "p"), ("nul", None)]
    got = {r["src"]: tuple(r)[1:] for r in op.resolve_redirects(spark.createDataFrame(data, "src string, dst string")).collect()}
    assert got["a"] == ("c", 2, False) and got["b"] == ("c", 1, False) and got["two"] == ("p", 1, False)
    assert all(got[s] == (None, None, True) for s in ("s", "x", "y", "z", "into"))
    assert all(got[f"n{i:03d}"] == ("n130", 130 - i, False) for i in range(130))
    assert len(got) == 138


def test_a_hot_redirect_target(spark):
    data = spark.range(3000).selectExpr("concat('p', id) src", "if(id % 3 = 0, 'hub', concat('p', id - 1)) dst").union(
        spark.createDataFrame([("hub", "home")], "src string, dst string")
    )
    got = op.resolve_redirects(data)
    assert got.where("final = 'home' and not is_cycle").count() == 3001
    assert {r["hops"] for r in got.collect()} == {1, 2, 3, 4}
