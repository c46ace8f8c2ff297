"""E-mail addresses: from links, from text, written out, and blocked ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from contactmine.functions.text import let, trim_ws

# Fixed value: an address.
EMAIL_PATTERN = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"

# The same matches in linear time: a try starts only where a run of
# local-part characters (or the rest after the last match) starts.
_EMAIL_SCAN = (
    r"(?:\G|(?<![a-zA-Z0-9._%+\-]))"
    r"([a-zA-Z0-9._%+\-]++@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,})"
)

# The written-out forms, in order.
_WORD = r"\p{L}\p{N}_"
_NAME = rf"(?<![{_WORD}.\-+])[{_WORD}.\-+]++"
_HOST = rf"[{_WORD}.\-+]+"
_WRITTEN_OUT = [
    (rf"(?i){_NAME}\s*\[at\]\s*{_HOST}\s*\[dot\]\s*[{_WORD}]+", "["),
    (rf"(?i){_NAME}\s*\(at\)\s*{_HOST}\s*\(dot\)\s*[{_WORD}]+", "("),
    (rf"{_NAME}\s*@\s*{_HOST}\s*\.\s*[{_WORD}]+", "@"),
]


def email_from_mailto(href: Column, check_address: bool = False) -> Column:
    """Address of a ``mailto:`` link without scheme and query.

    The link must hold an @; with ``check_address`` the address itself must.
    """
    address = trim_ws(
        F.substring_index(trim_ws(F.replace(href, F.lit("mailto:"), F.lit(""))), "?", 1)
    )
    checked = address if check_address else href
    return F.when(F.contains(checked, F.lit("@")), address)


def first_email(text: Column, max_chars: int | None = None) -> Column:
    """First address in the text (or in its first ``max_chars`` characters)."""
    scope = text if max_chars is None else F.left(text, F.lit(max_chars))
    found = let(F.regexp_extract(scope, _EMAIL_SCAN, 1), lambda e: F.when(e != "", e))
    return F.when(F.contains(scope, F.lit("@")), found)


def first_allowed_email(
    text: Column, blocked: Sequence[str], scan_all: bool = False
) -> Column:
    """First address unless it is blocked; ``scan_all`` looks on for one that is not."""
    block = [b.lower() for b in blocked]

    def allowed(address: Column) -> Column:
        return ~F.lower(address).isin(block) if block else F.lit(True)

    if not scan_all:
        return let(first_email(text), lambda e: F.when(allowed(e), e))
    every = F.regexp_extract_all(text, F.lit(_EMAIL_SCAN), F.lit(1))
    return F.when(F.contains(text, F.lit("@")), F.get(F.filter(every, allowed), F.lit(0)))


def written_out_email(text: Column, ignore_case: bool = False) -> Column:
    """Address written as ``name [at] host [dot] tld``, with parentheses, or spaced out.

    The words are replaced in lower case only, so ``[AT]`` is found but fails
    the final test; ``ignore_case`` lifts that.
    """
    flag = "(?i)" if ignore_case else ""

    def rewrite(found: Column) -> Column:
        signs = found
        for word, sign in [
            (r"\[at\]", "@"), (r"\[dot\]", "."), (r"\(at\)", "@"), (r"\(dot\)", "."),
        ]:
            signs = F.regexp_replace(signs, flag + word, sign)
        return F.replace(signs, F.lit(" "), F.lit(""))

    def accept(address: Column) -> Column:
        ok = F.contains(address, F.lit("@")) & F.contains(address, F.lit("."))
        return F.when(ok, address)

    tries = [
        F.when(
            F.contains(text, F.lit(mark)),
            let(rewrite(F.regexp_extract(text, pattern, 0)), accept),
        )
        for pattern, mark in _WRITTEN_OUT
    ]
    return F.coalesce(*tries)
