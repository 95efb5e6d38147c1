import re
import time

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from shardleaf.functions import text as T
from shardleaf.operators import text as op

QUIET = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
ANY = st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\0"), max_size=30)


def apply(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


@pytest.mark.parametrize("q, name", [
    ("====", "_3d_3d_3d_3d"), ("a b_c", "a_20b_5fc"), ("\t", "_09"), ("é~", "é_7e"), ("\U0001F600x", "\U0001F600x"),
    ("plain9", "plain9"), ("", ""), ("A", "_41"),
])
def test_match_name(spark, q, name):
    assert apply(spark, [q], T.match_name(F.col("x"))) == [name]


@QUIET
@given(st.lists(ANY, min_size=1, max_size=40))
def test_match_name_is_the_rule_per_character(spark, values):
    def rule(c):
        return c if c in "abcdefghijklmnopqrstuvwxyz0123456789" or ord(c) >= 0x80 else f"_{ord(c):02x}"

    assert apply(spark, values, T.match_name(F.col("x"))) == ["".join(map(rule, v)) for v in values]


def test_ready_made_ids_are_stripped_not_encoded(spark):
    got = apply(spark, ["SR_Foo_20bar", "sr12_x", "foo", "sr_"], T.ready_match_name(F.col("x")))
    assert got == ["foo_20bar", "x", "foo", ""]


def test_only_plain_spaces_are_trimmed(spark):
    assert apply(spark, ["  A b ", "\tA\t", " "], T.normal_query(F.col("x"))) == ["a b", "\ta\t", ""]
    assert apply(spark, [" a  b "], T.squeezed(F.col("x"))) == ["ab"]


@QUIET
@given(st.lists(st.text("ab \t\n\r  ﻿", max_size=25), min_size=1, max_size=40))
def test_blank_lines_like_the_ecmascript_rule(spark, values):
    blank = "[\t\n\x0b\f\r    -     　﻿]"

    def rule(v):
        return re.sub(r"\n*\Z", "", re.sub(rf"(?:\A|(?<=[\n\r  ])){blank}*\n", "\n", v), count=1)

    assert apply(spark, values, T.tidy_blank_lines(F.col("x"))) == [rule(v) for v in values]


@pytest.mark.parametrize("text, out", [("a\n\n\n\nb\n\n", "a\n\nb"), ("a\n  \n\t\nb", "a\n\nb"), ("\n\na", "\na"), ("a  \nb", "a  \nb")])
def test_runs_of_blank_lines(spark, text, out):
    assert apply(spark, [text], T.tidy_blank_lines(F.col("x"))) == [out]


@pytest.mark.parametrize("html, text", [
    ("&amp;lt;", "&lt;"), ("&#38;lt;", "&lt;"), ("a &lt;b&gt; &quot;&apos;", "a <b> \"'"), ("&#8230;&#x2026;&hellip;", "………"),
    ("&#128512;", "\U0001F600"), ("&nosuch; & &;", "&nosuch; & &;"), ("&#0;&#xD800;&#99999999999;", "���"), ("x", "x"),
    ("&eacute;&euro;&nbsp;", "é€ "), ("&Alpha;&alpha;", "Αα"),
    ("&check;&hyphen;&AMP;", "✓‐&"), ("&nbsp x &copy2 &notit;", "\u00a0 x ©2 ¬it;"), ("&#150;&#146;&#39 &#x41", "–’' A"), ("&fjlig;&acE;", "fj∾̳"),
])
def test_entities_are_decoded_once(spark, html, text):
    assert apply(spark, [html], T.decode_entities("x")) == [text]


def test_references_in_attributes_need_an_end(spark):
    assert apply(spark, ["?a=1&copy=2&lt=3&lt;&amp;&reg"], T.decode_entities("x", attribute=True)) == ["?a=1&copy=2&lt=3<&®"]


def page_text(spark, html, *drop):
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    return (op.page_text(df, drop) if drop else op.page_text(df)).first()["text"]


def test_listing_without_numbers_tips_and_folds(spark):
    html = (
        '<div class="line"><a name="l1"></a><span class="lineno">    1</span>int x;</div>\n'
        '<div class="line"><span class="lineno">    2</span><span class="keyword">if</span> (a &lt; b)</div>\n'
        '<div class="ttc" id="t"><div class="ttname">x</div><div class="ttdef"><div>deep</div>def</div></div>'
        '<div class="big foldclosed"><div>{…}</div></div>done\n\n'
    )
    assert page_text(spark, html) == "int x;\nif (a < b)\ndone"


def test_scripts_comments_and_chosen_elements(spark):
    html = '<p>a</p><!-- <p>no</p> --><script>var t="</p>";</script><nav><ul><li>n</li></ul></nav><div class=\'ad x\'>buy<div>now</div></div><DIV>b</DIV>'
    assert page_text(spark, html, "script", "nav", "div.ad") == "ab"
    assert page_text(spark, html, "script") == "anbuynowb"
    assert page_text(spark, '<div class="adx">keep</div><div class="ad">x', "div.ad") == "keepx"


@pytest.mark.parametrize("depth", [0, 1, 8, 9, 50, 1000])
def test_dropped_elements_nest_to_any_depth(spark, depth):
    inner = "<div>" * depth + "SECRET" + "</div>" * depth
    assert page_text(spark, f'a<div class="ttc">{inner}</div>b<div>c</div><div class="ttc">{inner}</div>d') == "abcd"


@pytest.mark.parametrize("html, text", [
    ("<span class=lineno>12</span>code", "code"), ("<i class='x lineno y'>1</i>code", "code"), ("a<script>var x=1;", "a"), ("a<!-- no end", "a"),
    ('<b title="a>b">x</b>', "x"), ("<b title=it's>x</b> it's", "x it's"), ("a < b <i", "a < b "), ("<br class=ttc>kept", "kept"),
    ('<div class="ttc">never closed <b>x</b>', "never closed x"), ('<p title="<div class=ttc>">x</p>', "x"),
])
def test_tags_as_browsers_read_them(spark, html, text):
    assert page_text(spark, html) == text


def test_long_pages_do_not_overflow(spark):
    inner = "<b>x</b> text " * 60_000
    assert page_text(spark, f'<div class="ttc">{inner}<div>{inner}</div></div>rest') == "rest"


@pytest.mark.parametrize("start, end, text, summary", [
    ("{", "}", "void f() {\n  x;\n}", "void f() {…}"), ("{", "}", "void f()\n{", "void f() {…}"), (None, None, "a b \nc", "a b  …"),
    ("/*", "*/", "/* text", "/* text /*…*/"), (".", "", "a.b. ", "a.b .…"), ("\\E(", ")", "x \\E(", "x \\E(…)"), ("{", "}", "a { {", "a { {…}"),
])
def test_fold_summary(spark, start, end, text, summary):
    df = spark.createDataFrame([(1, start, end, text)], "block_id int, start string, end string, text string")
    assert op.fold_summary(df).first()["summary"] == summary


def test_many_nested_elements_in_one_page(spark):
    """10,000 dropped elements that hold their own kind: what stays is taken once, not tested against each of them."""
    n = 10_000
    inner = "".join(f'<div class="x">a<div>b</div></div>k{i} ' for i in range(n))
    pages = spark.createDataFrame([(1, f"<p>{inner}</p>"), (2, '<div class="x">a<div>b</div></div>'), (3, '<div class=x>open<div>b</div>'), (4, None)], "page_id int, html string")
    start = time.perf_counter()
    got = {r.page_id: r.text for r in op.page_text(pages, [".x"]).collect()}
    assert got[1].split() == [f"k{i}" for i in range(n)] and got[2] == "" and got[3] == "openb" and got[4] is None
    assert time.perf_counter() - start < 30
