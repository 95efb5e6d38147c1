"""Links and metadata of raw HTML pages (page_id, url, html)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.links import resolve
from ..functions.text import ATTRIBUTES, RAW, VALUE, decode_entities, without_elements, without_tags

# A link element ends with its own slash, at its end tag, or where the next link begins.
_LINK = rf"""(?is)<a\s{ATTRIBUTES}(?<=["'\s]/)>|<a\s{ATTRIBUTES}>.*?(?=</a\s*>|<a\s|\z)"""
_META = rf"(?is)<meta\b{ATTRIBUTES}>"


def _up_to(name: str) -> str:
    """Pattern of a start tag up to the equals sign of an attribute, from attribute to attribute."""
    return rf"(?is)^<[a-z][^\s/>]*+(?:[\s/]++(?!{name}\s*=)[^\s/>][^\s=/>]*+(?:\s*+=\s*+{VALUE}?+)?+)*+[\s/]++{name}\s*+="


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of one start tag, null if absent."""
    quoted = F.regexp_extract(tag, rf"{_up_to(name)}\s*+({VALUE})", 1)
    return F.when(quoted != "", F.regexp_replace(quoted, r"""(?s)^(["'])(.*)\1$""", "$2"))


def extract_links(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(page_id, pos, href, anchor) and the kept page columns, in page order; narrow, one pass.

    Keep `url` to resolve the links later without joining the pages again.
    """
    html = without_elements(F.col("html"), RAW)
    links = F.filter(
        F.regexp_extract_all(html, F.lit(_LINK), F.lit(0)),
        lambda e: e.rlike(_up_to("href")),
    )
    rows = pages.select("page_id", *keep, F.posexplode(links).alias("pos", "element"))
    rows = rows.select(
        "page_id", *keep, "pos",
        F.coalesce(_attribute(F.col("element"), "href"), F.lit("")).alias("href"),
        without_tags(F.regexp_replace("element", rf"(?is)^<a\s{ATTRIBUTES}>", "")).alias("anchor"),
    )
    return rows.select(
        "page_id", *keep, "pos", decode_entities("href", attribute=True).alias("href"), decode_entities("anchor").alias("anchor")
    )


def page_base(pages: DataFrame, url: str = "url", out: str = "base_url") -> DataFrame:
    """Add the URL that the links of a page start from: what its first base element names, else its own."""
    tag = F.regexp_extract("html", rf"(?is)<base\b{ATTRIBUTES}>", 0)
    named = pages.withColumn("_href", F.when(tag.rlike(_up_to("href")), _attribute(tag, "href")))
    named = named.withColumn("_href", decode_entities("_href", attribute=True))
    return named.withColumn(out, F.coalesce(resolve(F.col(url), F.col("_href")), F.col(url))).drop("_href")


def page_meta(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(page_id, kept columns, title, lang, charset, generator, refresh_url); null where the page says nothing."""
    # Exploding one value keeps filters on the result above it, so a page is cleaned once.
    cleaned = F.explode(F.array(without_elements(F.col("html"), RAW))).alias("html")
    pages = pages.select("page_id", *keep, cleaned)
    html = F.col("html")
    metas = F.regexp_extract_all(html, F.lit(_META), F.lit(0))

    def meta(pattern: str) -> Column:
        return F.try_element_at(F.filter("metas", lambda m: m.rlike(pattern)), F.lit(1))

    content = _attribute(meta(_up_to("http-equiv") + r"\s*[\"']?content-type\b"), "content")
    refresh = _attribute(meta(_up_to("http-equiv") + r"\s*[\"']?refresh\b"), "content")
    generator = _attribute(meta(_up_to("name") + r"\s*[\"']?generator\b"), "content")

    def filled(c: Column) -> Column:
        return F.nullif(c, F.lit(""))

    return pages.select(
        "page_id", *keep, metas.alias("metas"),
        F.regexp_extract(html, rf"(?is)<html\b{ATTRIBUTES}>", 0).alias("root"),
        F.regexp_extract(html, rf"(?is)<title\b{ATTRIBUTES}>(.*?)</title\s*>", 1).alias("title"),
    ).select(
        "page_id", *keep,
        filled(decode_entities("title")).alias("title"),
        filled(F.coalesce(_attribute(F.col("root"), "lang"), F.lit(""))).alias("lang"),
        F.coalesce(
            filled(_attribute(meta(_up_to("charset")), "charset")),
            filled(F.regexp_extract(content, r"(?i)charset\s*=\s*([^\s;\"']+)", 1)),
        ).alias("charset"),
        filled(generator).alias("generator"),
        filled(F.trim(F.regexp_extract(refresh, r"(?is)url\s*=\s*[\"']?([^\"']*)", 1))).alias("refresh_url"),
    )
