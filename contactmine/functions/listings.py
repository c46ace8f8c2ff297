"""Property listings: type, status, match, notes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from contactmine.functions.keywords import keyword_hits_in_item
from contactmine.functions.text import WS, WS_JAVA, blank_to_null, let, title_case, trim_ws

# Property types, first hit in this order wins.
PROPERTY_TYPES = [
    "gas station", "former gas station", "gas station site",
    "car wash", "carwash", "express car wash", "tunnel wash",
    "retail", "retail property", "retail building",
    "office", "office building", "office space",
    "industrial", "warehouse", "distribution",
    "land", "vacant land", "development land",
    "restaurant", "qsr", "fast food",
    "automotive", "auto service", "auto repair",
    "special purpose", "specialty",
]

# Words that mark a listing as sold.
SOLD_WORDS = ["sold", "closed", "transaction"]

# Types too general to be shown in the notes.
GENERIC_TYPES = ["active listings", "active", "property listing", "listing match"]
FALLBACK_TYPE = "Property Listing"

# Headings of listing sections and the status they stand for.
SECTION_HEADINGS = [
    ("active listings", "Active"),
    ("active properties", "Active"),
    ("sold listings", "Sold"),
    ("sold properties", "Sold"),
    ("closed transactions", "Sold"),
]

LISTING_TYPE = (
    "struct<pos:int,status:string,title:string,description:string,type:string,"
    "full_text:string>"
)


# A type that holds an earlier one is never the first: the others, as they are shown.
_SHOWN_TYPES = [
    (phrase, phrase.title())
    for i, phrase in enumerate(PROPERTY_TYPES)
    if not any(earlier in phrase for earlier in PROPERTY_TYPES[:i])
]


def named_type(lowered: Column) -> Column:
    """First listed type in a lower-cased text, else ``Former X``, else null.

    Generated code but for the rare rest: no lambda around the text.
    """
    listed = F.coalesce(
        *[F.when(F.contains(lowered, F.lit(p)), F.lit(shown)) for p, shown in _SHOWN_TYPES]
    )
    word = F.regexp_extract(
        lowered, rf"former(?<=(?:^|[{WS_JAVA}])former)[{WS_JAVA}]+([^{WS}]+)", 1
    )
    former = let(
        word, lambda w: F.when(w != "", F.concat(F.lit("Former "), title_case(w)))
    )
    return F.coalesce(listed, F.when(F.contains(lowered, F.lit("former")), former))


def _named_type(text: Column) -> Column:
    """The same for any text, which is lower-cased once wherever this stands."""
    return let(F.lower(text), named_type)


def property_type(text: Column) -> Column:
    """First listed type in the text, else ``Former X``, else an empty text."""
    return F.coalesce(_named_type(text), F.lit(""))


def listing_type(lowered: Column, label: Column) -> Column:
    """Type found in the lower-cased text, else the listing's own label, else an empty text."""
    return F.coalesce(named_type(lowered), trim_ws(label), F.lit(""))


def listing_status(text: Column) -> Column:
    lowered = F.lower(text)
    sold = F.lit(False)
    for word in SOLD_WORDS:
        sold = sold | F.contains(lowered, F.lit(word))
    return F.when(sold, F.lit("Sold")).otherwise(F.lit("Active"))


def status_order(status: Column) -> Column:
    return F.when(status == "Sold", 1).otherwise(0)


def matched_type(
    type_: Column,
    title: Column,
    description: Column,
    title_chars: int | None = None,
    description_chars: int | None = None,
) -> Column:
    """What to call a matching listing: its type, its title's, its description's, or a fallback.

    Title and description are used whole unless their leading characters are asked for.
    """

    def head(c: Column, n: int | None) -> Column:
        return c if n is None else F.left(c, F.lit(n))

    from_title = F.when(title != "", F.coalesce(_named_type(title), head(title, title_chars)))
    from_description = F.when(
        description != "", _named_type(head(description, description_chars))
    )
    return F.coalesce(
        F.when(type_ != "", type_), from_title, from_description, F.lit(FALLBACK_TYPE)
    )


def in_listing_order(listings: Column) -> Column:
    """Active listings before sold ones, page order within each."""
    return let(
        listings,
        lambda every: F.concat(
            F.filter(every, lambda x: x["status"] == "Active"),
            F.filter(every, lambda x: x["status"] == "Sold"),
        ),
    )


def listing_hits(ordered: Column, keywords: Sequence[str]) -> Column:
    """Keywords over all listings, first seen first, no repeats."""
    return F.array_distinct(
        F.flatten(F.transform(ordered, lambda x: keyword_hits_in_item(x["full_text"], keywords)))
    )


def first_match(ordered: Column, keywords: Sequence[str]) -> Column:
    """``struct<matched_type, match_source>`` of the first listing with a keyword."""
    hit = F.get(
        F.filter(
            ordered, lambda x: F.size(keyword_hits_in_item(x["full_text"], keywords)) > 0
        ),
        F.lit(0),
    )
    return let(
        hit,
        lambda x: F.when(
            x.isNotNull(),
            F.struct(
                matched_type(x["type"], x["title"], x["description"]).alias(
                    "matched_type"
                ),
                x["status"].alias("match_source"),
            ),
        ),
    )


def listing_note(match_source: Column, type_: Column, hits: Column) -> Column:
    """``Source: Type — keywords: a; b``; a general type gives way to the first keyword."""
    shown = F.lower(F.coalesce(type_, F.lit("")))
    specific = (shown != "") & ~shown.isin(GENERIC_TYPES)
    some = F.size(hits) > 0
    head = F.when(
        match_source.isNotNull(),
        F.when(specific, F.concat(match_source, F.lit(": "), type_))
        .when(some, F.concat(match_source, F.lit(": "), title_case(F.get(hits, F.lit(0)))))
        .otherwise(F.concat(match_source, F.lit(" Listing Match"))),
    )
    tail = F.when(some, F.concat(F.lit("keywords: "), F.array_join(hits, "; ")))
    return blank_to_null(F.concat_ws(" — ", head, tail))


def combined_text(body: Column, ordered: Column) -> Column:
    """Page text followed by all listing texts."""
    return F.concat_ws(
        " ", body, F.array_join(F.transform(ordered, lambda x: x["full_text"]), " ")
    )
