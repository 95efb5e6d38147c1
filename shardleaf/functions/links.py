"""Link expressions: joining an href to its base, link keys, URL parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def origin(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def _scheme(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)


def _without_dots(path: Column) -> Column:
    """Resolve `.` and `..` parts of an absolute path; only paths that hold such a part pay for it."""
    parts = F.split(F.substr(path, F.lit(2)), "/")
    last = F.element_at(parts, -1)

    def step(stack: Column, part: Column) -> Column:
        shorter = F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))
        return (
            F.when(part == "..", shorter).when(part == ".", stack).otherwise(F.concat(stack, F.array(part)))
        )

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    tail = F.when(last.isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    clean = F.concat(F.lit("/"), F.array_join(kept, "/"), tail)
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), clean).otherwise(path)


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of href on a page at base: absolute, `//host`, `/x`, `./x`, `x`, `?q` and `#part`.

    White space round an href does not count, nor do tabs and line ends inside.
    """
    href = F.regexp_replace(href, r"^[\t\n\f\r ]+|[\t\n\f\r ]+$|[\t\n\r]", "")
    site = origin(base)
    bare = F.regexp_replace(base, r"#.*$", "")
    page = F.regexp_replace(bare, r"\?.*$", "")
    path = F.substr(page, F.length(site) + 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(path, r"^(.*/)[^/]*$", 1), F.lit("")), F.lit("/"))
    target = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.substr(href, F.length(target) + 1)
    full = F.when(target.startswith("/"), target).otherwise(F.concat(folder, target))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(_scheme(base), href))
        .when(href == "", bare)
        .when(href.startswith("#"), F.concat(bare, href))
        .when(href.startswith("?"), F.concat(page, href))
        .otherwise(F.concat(site, _without_dots(full), rest))
    )


def tip_key(href: Column) -> Column:
    """Key under which a definition is kept: text after the last slash, other characters as `_`."""
    return F.concat(F.lit("#a"), F.regexp_replace(F.regexp_replace(href, r"(?s)^.*/", ""), r"[^a-z_A-Z0-9]", "_"))


def url_query(url: Column) -> Column:
    """Decoded text after `?`, null if there is none; a plus sign stays, bad escapes leave it undecoded."""
    raw = F.nullif(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), F.lit(""))
    return F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)


# Kinds of documentation pages by file name, first match wins.
PAGE_RULES: tuple[tuple[str, str], ...] = (
    ("members", r"-members\.html$"),
    ("source", r"_source\.html$"),
    ("class", r"^class_"),
    ("struct", r"^struct"),
    ("namespace", r"^namespace_"),
    ("file", r"_8[a-z]+\.html$"),
    ("index", r"^(index|pages|namespaces|namespacemembers.*|annotated|classes|hierarchy|inherits|functions.*|files|globals.*)\.html$"),
)


def link_kind(href: Column, rules: Sequence[tuple[str, str]] = PAGE_RULES, default: str | None = "other") -> Column:
    """Kind of the first rule whose pattern is found, as one expression."""
    kind = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, pattern in rules:
        kind = kind.when(href.rlike(pattern), F.lit(name))
    return kind.otherwise(F.lit(default).cast("string"))


def compiles(pattern: Column) -> Column:
    """Whether a text is a regular expression; false for null."""
    tried = F.call_function("try_reflect", F.lit("java.util.regex.Pattern"), F.lit("matches"), pattern, F.lit(""))
    return pattern.isNotNull() & tried.isNotNull()
