"""Listings of a page: read from its cards, or from a listing table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from contactmine.functions import dom as D
from contactmine.functions.listings import (
    LISTING_TYPE,
    SECTION_HEADINGS,
    listing_status,
    listing_type,
    matched_type,
    property_type,
    status_order,
)
from contactmine.functions.text import let
from contactmine.operators.frontier import cap_per_group
from contactmine.operators.matching import with_hits

# What makes an element a listing card, and its parts.
CARD_CLASSES = ["listing", "property"]
_TITLE_TAGS = ["h2", "h3", "h4", "h5"]
_TITLE_CLASSES = ["title", "name", "heading"]
_DESCRIPTION_CLASSES = ["description", "overview", "summary", "details"]
_TYPE_CLASSES = ["type", "category"]
_SECTION_MIN_CHARS = 50

_is_card = D.any_of(
    D.class_holds(*CARD_CLASSES),
    D.attr_holds("data-testid", "listing"),
    D.tag_in(["article"]),
    lambda n: F.coalesce(D.attr(n, "role"), F.lit("")) == "article",
)


def listing_cards(dom: Column, cap: int | None = None) -> Column:
    """The page's cards in document order, on request only the first ``cap``."""
    cards = F.filter(dom, _is_card)
    return cards if cap is None else F.slice(cards, F.lit(1), F.lit(cap))


def _part(dom: Column, body: Column, card: Column, test: D.Test) -> Column:
    inside = D.first(D.descendants(dom, card), test)
    return F.coalesce(D.text_of(body, inside), F.lit(""))


def listing_fields(
    pos: Column,
    raw: Column,
    lowered: Column,
    title: Column,
    description: Column,
    label: Column,
    around: Column,
) -> list[Column]:
    """The fields of one listing; ``raw`` is its joined text, ``lowered`` that in lower case."""
    return [
        pos.cast("int").alias("pos"),
        listing_status(F.concat_ws(" ", raw, around)).alias("status"),
        F.lower(title).alias("title"),
        F.lower(description).alias("description"),
        listing_type(lowered, label).alias("type"),
        lowered.alias("full_text"),
    ]


def card_listings(dom: Column, body: Column, cap: int | None = None) -> Column:
    """Array of listing structs, one per card that has any text."""

    def read(card: Column, pos: Column) -> Column:
        parts = F.struct(
            _part(
                dom, body, card,
                D.any_of(D.tag_in(_TITLE_TAGS), D.class_holds(*_TITLE_CLASSES)),
            ).alias("title"),
            _part(
                dom, body, card,
                D.any_of(D.class_holds(*_DESCRIPTION_CLASSES), D.tag_in(["p"])),
            ).alias("description"),
            _part(dom, body, card, D.class_holds(*_TYPE_CLASSES)).alias("label"),
            F.coalesce(D.text_of(body, D.parent(dom, card)), F.lit("")).alias("around"),
        )
        def build(p: Column) -> Column:
            raw = F.trim(F.concat_ws(" ", p["title"], p["description"], p["label"]))

            def fields(r: Column) -> Column:
                made = listing_fields(
                    pos, r["raw"], r["lowered"], p["title"], p["description"], p["label"], p["around"]
                )
                return F.when(r["raw"] != "", F.struct(*made))

            bound = let(raw, lambda r: F.struct(r.alias("raw"), F.lower(r).alias("lowered")))
            return let(bound, fields)

        return let(parts, build)

    return F.filter(
        F.transform(listing_cards(dom, cap), read), lambda x: x.isNotNull()
    )


def section_listings(dom: Column, body: Column) -> Column:
    """Listings from labelled sections: the element after each heading, over 50 characters."""

    def read(i: int, heading: str, status: str) -> Column:
        text = D.text_of(body, let(D.by_text(dom, body, heading), lambda n: D.following(dom, n)))
        return let(
            text,
            lambda t: F.when(
                F.length(t) > _SECTION_MIN_CHARS,
                F.struct(
                    F.lit(i).alias("pos"),
                    F.lit(status).alias("status"),
                    F.lit("").alias("title"),
                    F.lower(t).alias("description"),
                    property_type(t).alias("type"),
                    F.lower(t).alias("full_text"),
                ),
            ),
        )

    found = [read(i, h, s) for i, (h, s) in enumerate(SECTION_HEADINGS)]
    return F.array_compact(F.array(*found))


def page_listings(dom: Column, body: Column, cap: int | None = None) -> Column:
    """Listings from cards, or from sections on pages without card listings."""
    cards = card_listings(dom, body, cap).cast(f"array<{LISTING_TYPE}>")
    sections = section_listings(dom, body).cast(f"array<{LISTING_TYPE}>")
    return let(
        cards,
        lambda c: F.when(F.size(c) > 0, c).otherwise(F.coalesce(sections, c)),
    )


def listings_table(df: DataFrame, *keys: str) -> DataFrame:
    """One row per listing."""
    return df.select(*keys, F.inline("listings"))


# The same rules over a table with one row per card.


def listing_rows(cards: DataFrame, key: str = "page_id", cap: int | None = None) -> DataFrame:
    """Cards ``(key, pos, title, description, type, parent_text)`` to listing rows.

    Without a cap per page nothing is shuffled.
    """
    capped = cap_per_group(cards, [key], cap, ("pos",))

    texts = [F.coalesce(F.col(c), F.lit("")) for c in ("title", "description", "type")]
    joined = capped.withColumn("_raw", F.trim(F.concat_ws(" ", *texts)))
    around = F.coalesce(F.col("parent_text"), F.lit(""))
    # A column of its own: the tests on it read it, they do not make it again.
    filled = joined.filter(F.col("_raw") != "").withColumn("_lowered", F.lower("_raw"))
    return filled.select(
        key, *listing_fields(F.col("pos"), F.col("_raw"), F.col("_lowered"), *texts, around)
    )


def keyword_sightings(
    listings: DataFrame, keywords: Sequence[str], key: str = "page_id"
) -> DataFrame:
    """Per page and keyword, the earliest listing that holds it: ``(key, kw, at)``.

    Made once for a query that asks for the first match and for the keywords: both
    read it whole, so that listings are read, searched and shuffled once.
    """
    sightings = with_hits(listings, "full_text", keywords).select(
        key,
        status_order(F.col("status")).alias("o"),
        "pos",
        matched_type(F.col("type"), F.col("title"), F.col("description")).alias("t"),
        "status",
        F.posexplode("hits").alias("k", "kw"),
    )
    return sightings.groupBy(key, "kw").agg(
        F.min(F.struct("o", "pos", "k", "t", "status")).alias("at")
    )


def first_listing_match(
    listings: DataFrame,
    keywords: Sequence[str],
    key: str = "page_id",
    sightings: DataFrame | None = None,
) -> DataFrame:
    """Per page, the first listing with a keyword: active before sold, then position.

    With ``sightings``, the ``keyword_sightings`` of the same listings and keywords.
    """
    if sightings is not None:
        at = F.col("at")
        candidates = sightings.select(
            key, F.struct(at["o"].alias("o"), at["pos"].alias("pos"), at["t"].alias("t"), at["status"].alias("status")).alias("m")
        )
    else:
        matching = with_hits(listings, "full_text", keywords)
        kind = matched_type(F.col("type"), F.col("title"), F.col("description"))
        candidates = matching.select(
            key,
            F.struct(
                status_order(F.col("status")).alias("o"), "pos", kind.alias("t"), "status"
            ).alias("m"),
        )
    return (
        candidates.groupBy(key)
        .agg(F.min("m").alias("m"))
        .select(
            key,
            F.col("m.t").alias("matched_type"),
            F.col("m.status").alias("match_source"),
        )
    )


def listing_keyword_lists(
    listings: DataFrame,
    keywords: Sequence[str],
    key: str = "page_id",
    sightings: DataFrame | None = None,
) -> DataFrame:
    """Per page, keywords over all its listings, first seen first.

    Only the earliest sighting of each keyword travels, so a page's list is
    never longer than the keyword list. With ``sightings``, the
    ``keyword_sightings`` of the same listings and keywords.
    """
    if sightings is not None:
        at = F.col("at")
        earliest = sightings.select(
            key, "kw", F.struct(at["o"].alias("o"), at["pos"].alias("pos"), at["k"].alias("k")).alias("at")
        )
    else:
        found = with_hits(listings, "full_text", keywords).select(
            key,
            status_order(F.col("status")).alias("o"),
            "pos",
            F.posexplode("hits").alias("k", "kw"),
        )
        earliest = found.groupBy(key, "kw").agg(F.min(F.struct("o", "pos", "k")).alias("at"))
    return earliest.groupBy(key).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("at", "kw"))), lambda x: x["kw"]
        ).alias("hits")
    )


def combined_texts(
    bodies: DataFrame, listings: DataFrame, key: str = "page_id", body: str = "body_text"
) -> DataFrame:
    """Page text followed by its listing texts, all of them."""
    texts = listings.groupBy(key).agg(
        F.array_join(
            F.transform(
                F.array_sort(
                    F.collect_list(
                        F.struct(status_order(F.col("status")).alias("o"), "pos", "full_text")
                    )
                ),
                lambda x: x["full_text"],
            ),
            " ",
        ).alias("_listed")
    )
    return bodies.join(texts, key, "left").select(
        key,
        F.concat(F.col(body), F.lit(" "), F.coalesce("_listed", F.lit(""))).alias(
            "combined_text"
        ),
    )
