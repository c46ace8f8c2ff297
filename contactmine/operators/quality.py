"""Page-quality tests: redirects, interstitials, paging controls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from contactmine.functions import dom as D
from contactmine.functions.text import decode_entities, trim_ws

# What an interstitial page shows in its URL, title and body.
CHALLENGE_URL = ["challenge", "cf-browser-verification"]
CHALLENGE_TITLE = ["cloudflare"]
CHALLENGE_BODY = ["verify you are human", "performing security verification"]


def landed_on(pages: DataFrame, needle: str) -> DataFrame:
    """Drop pages that ended on another host or path."""
    return pages.filter(F.contains("final_url", F.lit(needle)))


def page_title(html: Column) -> Column:
    title = F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)
    return trim_ws(decode_entities(title))


def _holds_any(col: Column, phrases: Sequence[str]) -> Column:
    lowered = F.lower(F.coalesce(col, F.lit("")))
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | F.contains(lowered, F.lit(phrase))
    return hit


def is_challenge(url: Column, title: Column, text: Column) -> Column:
    return (
        _holds_any(url, CHALLENGE_URL)
        | _holds_any(title, CHALLENGE_TITLE)
        | _holds_any(text, CHALLENGE_BODY)
    )


def has_next_page(dom: Column, body: Column) -> Column:
    """An enabled "next" button, any "next" link, or an enabled element labelled "next"."""

    def named(n: Column) -> Column:
        label = F.coalesce(F.nullif(D.attr(n, "aria-label"), F.lit("")), D.text_of(body, n))
        return F.coalesce(label.rlike("(?i)next"), F.lit(False))

    def enabled(n: Column) -> Column:
        return D.attr(n, "disabled").isNull() & (
            F.coalesce(D.attr(n, "aria-disabled"), F.lit("")) != "true"
        )

    def is_button(n: Column) -> Column:
        kind = F.lower(F.coalesce(D.attr(n, "type"), F.lit("")))
        return (
            (n["tag"] == "button")
            | ((n["tag"] == "input") & kind.isin("button", "submit", "reset"))
            | (F.coalesce(D.attr(n, "role"), F.lit("")) == "button")
        )

    def is_link(n: Column) -> Column:
        return ((n["tag"] == "a") & D.attr(n, "href").isNotNull()) | (
            F.coalesce(D.attr(n, "role"), F.lit("")) == "link"
        )

    button = D.first(dom, lambda n: is_button(n) & named(n))
    arrow = D.first(dom, D.attr_holds("aria-label", "next", ignore_case=True))
    return (
        F.coalesce(F.when(button.isNotNull(), enabled(button)), F.lit(False))
        | F.exists(dom, lambda n: is_link(n) & named(n))
        | F.coalesce(F.when(arrow.isNotNull(), enabled(arrow)), F.lit(False))
    )
