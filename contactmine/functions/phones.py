"""Phone numbers: from text patterns and from ``tel:`` links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from contactmine.functions.text import WS, let, trim_ws

# Phone patterns, in the order they are tried.
PHONE_PATTERNS = [
    rf"\(?\d{{3}}\)?[{WS}.\-]?\d{{3}}[{WS}.\-]?\d{{4}}",
    rf"\d{{3}}[{WS}.\-]\d{{3}}[{WS}.\-]\d{{4}}",
    r"\d{10}",
]


def phone_digits(col: Column) -> Column:
    return F.regexp_replace(col, "[^0-9]", "")


def national_digits(digits: Column) -> Column:
    """Drop the leading 1 of an 11-digit number."""
    return F.when(
        (F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)
    ).otherwise(digits)


def is_blocked_phone(digits: Column, blocked: Sequence[str]) -> Column:
    """True for a listed number, with or without its leading 1."""
    if not blocked:
        return F.lit(False)
    return (F.length(digits) >= 10) & national_digits(digits).isin(list(blocked))


def first_phone(text: Column, max_chars: int | None = None) -> Column:
    """First match of the main pattern, stripped."""
    scope = text if max_chars is None else F.left(text, F.lit(max_chars))
    return F.nullif(trim_ws(F.regexp_extract(scope, PHONE_PATTERNS[0], 0)), F.lit(""))


def first_allowed_phone(
    text: Column,
    blocked: Sequence[str] = (),
    patterns: Sequence[str] = tuple(PHONE_PATTERNS),
) -> Column:
    """Per pattern only the first match counts: ten digits and not blocked, else next pattern."""

    def allowed(phone: Column) -> Column:
        return let(
            national_digits(phone_digits(phone)),
            lambda d: (F.length(d) == 10) & ~is_blocked_phone(d, blocked),
        )

    tries = [
        let(trim_ws(F.regexp_extract(text, p, 0)), lambda m: F.when(allowed(m), m))
        for p in patterns
    ]
    return F.coalesce(*tries)


def tel_number(href: Column) -> Column:
    """Number of a ``tel:`` link without scheme and query."""
    return trim_ws(
        F.substring_index(trim_ws(F.replace(href, F.lit("tel:"), F.lit(""))), "?", 1)
    )


def phone_from_tel(href: Column, text: Column) -> Column:
    """The link's number, else its text; either must hold three digits in a row."""
    return F.coalesce(
        let(tel_number(href), lambda n: F.when(n.rlike(r"\d{3}"), n)),
        F.when(text.rlike(r"\d{3}"), trim_ws(text)),
    )


def phone_from_tel_links(links: Column, blocked: Sequence[str]) -> Column:
    """First usable link of an array of ``struct<href, text>``, in page order.

    First pass: links with at least ten digits that are not blocked, shown by
    their text when it holds a digit. Second pass: the same test on the texts.
    """

    def usable(digits: Column) -> Column:
        return (F.length(digits) >= 10) & ~is_blocked_phone(digits, blocked)

    by_number = F.get(
        F.filter(links, lambda n: let(phone_digits(tel_number(n["href"])), usable)),
        F.lit(0),
    )
    by_text = F.get(
        F.filter(
            links,
            lambda n: n["text"].rlike(r"\d{3}") & let(phone_digits(n["text"]), usable),
        ),
        F.lit(0),
    )
    return F.coalesce(
        let(
            by_number,
            lambda n: F.when(n["text"].rlike(r"\d"), trim_ws(n["text"])).otherwise(
                tel_number(n["href"])
            ),
        ),
        trim_ws(by_text["text"]),
    )
