"""Tests that tell a company name from other text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from contactmine.functions.locations import has_location
from contactmine.functions.text import WS, let, text_array, text_lines, trim_ws

# Words a company line must not hold.
SKIP_WORDS = [
    "city", "state", "location", "address", "zip", "phone", "email", "@",
    "logo", "image", "photo", "picture", "profile", "broker", "view",
]

# Section headings that are no company name.
STOCK_HEADINGS = [
    "company overview", "broker profile", "services offered", "areas served",
]


def is_company_like(text: Column) -> Column:
    """Up to 200 characters, no phone or share label, not only digits and punctuation."""
    lowered = F.lower(text)
    return (
        (text != "")
        & (F.length(text) <= 200)
        & ~lowered.startswith("phone")
        & ~F.contains(lowered, F.lit("show phone"))
        & (lowered != "share")
        & ~trim_ws(text).rlike(rf"^[\d{WS}\-().]+$")
    )


def is_company_candidate(text: Column, word_boundary: bool = False) -> Column:
    """2-200 characters and no skip word; by substring unless ``word_boundary``."""
    lowered = F.lower(text)
    if word_boundary:
        names = "|".join(w for w in SKIP_WORDS if w.isalpha())
        edge = r"[\p{L}\p{N}_]"
        skipped = lowered.rlike(rf"(?<!{edge})(?:{names})(?!{edge})|@")
    else:
        skipped = F.exists(text_array(SKIP_WORDS), lambda w: F.contains(lowered, w))
    return F.length(text).between(2, 200) & ~skipped


def company_heading(text: Column) -> Column:
    """A short heading that is none of the stock section headings."""
    lowered = F.lower(text)
    stock = F.exists(text_array(STOCK_HEADINGS), lambda p: F.contains(lowered, p))
    return F.when((text != "") & (F.length(text) < 200) & ~stock, text)


def line_above_location(text: Column, word_boundary: bool = False) -> Column:
    """The line just above the first line with a city and state, if it may be a company."""

    def above(lines: Column) -> Column:
        at = F.array_position(F.transform(lines, has_location), True).cast("int")
        return let(at, lambda i: F.when(i > 1, F.get(lines, i - 2)))

    return let(
        let(text_lines(text), above),
        lambda line: F.when(is_company_candidate(line, word_boundary), line),
    )


def without_prefix_word(text: Column, prefixes: tuple[str, ...]) -> Column:
    """The text minus the first listed word it starts with, or NULL when nothing is left."""
    pattern = rf"(?is)^(?:{'|'.join(prefixes)})[{WS}]*"
    return F.nullif(trim_ws(F.regexp_replace(text, pattern, "")), F.lit(""))
