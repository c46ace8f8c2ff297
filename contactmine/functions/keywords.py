"""Keyword matching on a text column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from contactmine.functions.text import blank_to_null, let, text_array
from contactmine.schema import MISSING


def keyword_hits(text: Column, keywords: Sequence[str]) -> Column:
    """Keywords contained in the text, case-insensitively, in list order.

    The sentinel text never matches. Only generated code here, no lambda and
    no branch around the text: it is then lower-cased once for all tests.
    """
    if any(kw.lower() in MISSING.lower() for kw in keywords):
        text = F.nullif(text, F.lit(MISSING))
    lowered = F.lower(text)
    found = [
        F.when(F.contains(lowered, F.lit(kw.lower())), F.lit(kw)).otherwise(F.lit(""))
        for kw in keywords
    ]
    return F.array_remove(F.array(*found), "")


def keyword_hits_in_item(text: Column, keywords: Sequence[str]) -> Column:
    """The same hits, for the items of an array, where no code is generated."""
    return let(
        F.lower(text),
        lambda lowered: F.filter(
            text_array(keywords), lambda kw: F.contains(lowered, F.lower(kw))
        ),
    )


def may_hold_keyword(text: Column, keywords: Sequence[str]) -> Column:
    """True where every word of some keyword occurs somewhere in the text.

    A necessary condition for a match in any re-arrangement of the text's
    pieces, cheap enough to run before a page is parsed.
    """
    lowered = F.lower(text)
    condition = F.lit(False)
    for kw in keywords:
        every_word = F.lit(True)
        for word in kw.lower().split():
            every_word = every_word & F.contains(lowered, F.lit(word))
        condition = condition | every_word
    return condition


def merge_hits(first: Column, second: Column) -> Column:
    """All hits of the first array, then the new ones of the second."""
    return F.array_union(first, second)


def keyword_note(hits: Column) -> Column:
    return F.coalesce(blank_to_null(F.array_join(hits, "; ")), F.lit(MISSING))
