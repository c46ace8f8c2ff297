"""Links: extraction from markup, resolution, tests and page numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from contactmine.functions.text import HIDDEN_PATTERN, decode_entities, let, trim_ws

# Shapes of a profile URL. The third is completed with a host.
PROFILE_URL_NUMBERED = r"(?i)/business-broker/[^/]+/[^/]+/BW\d+"
PROFILE_URL_ASPX = r"(?i)/brokers/[a-z0-9][a-z0-9\-]+-\d+\.aspx"


def profile_url_slug(host: str) -> str:
    return rf"(?i){host.replace('.', chr(92) + '.')}/profile/([a-z0-9\-]+)"


# Attributes are read one by one, so only an attribute named href counts, and each
# tag is read once.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'<>]++)"""
_OTHER_ATTRIBUTES = rf"""(?:[\s/]++(?!href[\s=])[^\s/<>=]++(?:\s*+=\s*+{_VALUE})?+)*+"""
_HREF = rf"""{_OTHER_ATTRIBUTES}[\s/]++href\s*+=\s*+({_VALUE})"""
LINK_PATTERN = rf"(?i)<a(?=[\s/]){_HREF}"
ANY_LINK_PATTERN = rf"(?i)<[a-z][^\s/<>]*+{_HREF}"

_AUTHORITY = r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)"


def page_hrefs(html: Column, any_element: bool = False) -> Column:
    """Non-empty hrefs of a page in document order, scripts and comments left out."""
    shown = F.regexp_replace(html, HIDDEN_PATTERN, " ")
    hrefs = F.regexp_extract_all(
        shown, F.lit(ANY_LINK_PATTERN if any_element else LINK_PATTERN), F.lit(1)
    )
    bare = F.transform(hrefs, lambda h: F.regexp_replace(h, r"""^["']|["']$""", ""))
    return F.filter(F.transform(bare, lambda h: trim_ws(decode_entities(h))), lambda h: h != "")


def url_host(url: Column) -> Column:
    return F.nullif(
        F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1)), F.lit("")
    )


def _fold_dots(path: Column, drop_empty: bool) -> Column:
    """Resolve ``.`` and ``..`` and perhaps drop empty inner segments of a rooted path."""
    parts = F.split(path, "/")
    kept = parts
    if drop_empty:
        kept = F.filter(
            parts, lambda s, i: (s != "") | (i == 0) | (i == F.size(parts) - 1)
        )
    empty = F.array().cast("array<string>")
    folded = F.aggregate(
        kept,
        empty,
        lambda acc, s: F.when(
            s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        )
        .when(s == ".", acc)
        .otherwise(F.array_append(acc, s)),
    )
    closed = F.when(
        F.try_element_at(parts, F.lit(-1)).isin(".", ".."),
        F.array_append(folded, F.lit("")),
    ).otherwise(folded)
    joined = F.array_join(closed, "/")
    rooted = F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))
    messy = path.rlike(r"//|(^|/)\.{1,2}(/|$)" if drop_empty else r"(^|/)\.{1,2}(/|$)")
    return F.when(messy, rooted).otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """The absolute URL of an href found on the page ``base``."""
    no_fragment = F.substring_index(base, "#", 1)
    no_query = F.substring_index(no_fragment, "?", 1)
    root = F.regexp_extract(base, _AUTHORITY, 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*:)", 1)
    base_path = F.substr(no_query, F.length(root) + 1)
    folder = F.when(base_path == "", F.lit("/")).otherwise(
        F.regexp_replace(base_path, r"[^/]*$", "")
    )
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    tail = F.substr(href, F.length(path) + 1)
    folded = F.when(
        path.startswith("/"), let(path, lambda p: _fold_dots(p, drop_empty=False))
    ).otherwise(let(F.concat(folder, path), lambda p: _fold_dots(p, drop_empty=True)))
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(href.startswith("?"), F.concat(no_query, href))
        .otherwise(F.concat(root, folded, tail))
    )


def is_profile_url(url: Column, pattern: str, min_slug: int = 0) -> Column:
    """Pattern test; with ``min_slug`` the pattern's group must be that long."""
    if min_slug:
        return F.length(F.regexp_extract(url, pattern, 1)) >= min_slug
    return url.rlike(pattern)


def holds_none_of(url: Column, parts: Sequence[str]) -> Column:
    clean = F.lit(True)
    for part in parts:
        clean = clean & ~F.contains(F.lower(url), F.lit(part.lower()))
    return clean


def skip_first(items: Column, n: int) -> Column:
    """Drop the first ``n`` items when there are more than ``n``, else keep all."""
    size = F.size(items)
    return F.when(size > n, F.slice(items, F.lit(n + 1), size - n)).otherwise(items)


def directory_page_url(base: Column, page_num: Column) -> Column:
    """Page 1 is the base with a closing slash, page N is ``base/page-N/``."""
    stem = F.regexp_replace(base, "/+$", "")
    first = F.when(base.endswith("/"), base).otherwise(F.concat(stem, F.lit("/")))
    return F.when(page_num <= 1, first).otherwise(
        F.concat(stem, F.lit("/page-"), page_num.cast("string"), F.lit("/"))
    )
