"""Contact fields read from a parsed page (``dom`` and ``body_text``), by layout.

Every function is an ordered chain of tries; a later try is evaluated only
where the earlier ones gave NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from contactmine.functions import dom as D
from contactmine.functions.companies import (
    company_heading,
    is_company_candidate,
    is_company_like,
    line_above_location,
    without_prefix_word,
)
from contactmine.functions.emails import email_from_mailto, first_email, written_out_email
from contactmine.functions.locations import LocationRule, find_location, first_location
from contactmine.functions.phones import first_phone, phone_from_tel, phone_from_tel_links
from contactmine.functions.text import WS, blank_to_null, first_line, let, squeeze_ws, text_lines, trim_ws

# The word an icon's text may start with.
ICON_PREFIXES = ("apartment", "building", "company")

# Words that mark a map pin, a place and a company icon.
_PIN = D.any_of(
    D.class_holds("pin", "location", "map"),
    D.attr_holds("data-testid", "location"),
    D.attr_holds("aria-label", "location", ignore_case=True),
)
_PLACE = D.class_holds("location", "address", "city")
_ICON = D.class_holds("apartment", "building")


# -- single elements ---------------------------------------------------------


def tag_text(dom: Column, body: Column, *tags: str) -> Column:
    """Text of the first element with one of the tags."""
    return blank_to_null(D.text_of(body, D.first(dom, D.tag_in(tags))))


def heading_text(dom: Column, body: Column) -> Column:
    """Text of the first heading of any level."""
    is_heading = D.any_of(
        D.tag_in(D.HEADINGS),
        lambda n: F.coalesce(D.attr(n, "role"), F.lit("")) == "heading",
    )
    return blank_to_null(D.text_of(body, D.first(dom, is_heading)))


def label_sibling_text(dom: Column, body: Column, label: str) -> Column:
    """Text of the element right after the labelled one."""
    return let(
        D.by_text(dom, body, label),
        lambda n: blank_to_null(D.text_of(body, D.next_sibling(dom, n))),
    )


def label_parent_text(dom: Column, body: Column, label: str) -> Column:
    return let(
        D.by_text(dom, body, label),
        lambda n: blank_to_null(D.text_of(body, D.parent(dom, n))),
    )


def main_or_body_text(dom: Column, body: Column) -> Column:
    return F.coalesce(tag_text(dom, body, "main"), body)


def labelled_block(
    dom: Column, body: Column, labels: Sequence[str], max_chars: int | None = None
) -> Column:
    """Prose around the first label, on request only if shorter than ``max_chars``.

    Without one, the first paragraph or block of the main part.
    """

    def short(text: Column) -> Column:
        return text if max_chars is None else let(text, lambda t: F.when(F.length(t) < max_chars, t))

    tries = [short(label_parent_text(dom, body, label)) for label in labels]
    mains = F.filter(dom, D.tag_in(["main"]))
    prose = F.filter(dom, D.any_of(D.has_class("content"), D.has_class("profile")))

    def under(outer: Column, n: Column) -> Column:
        return F.exists(
            outer, lambda a: (a["node_id"] < n["node_id"]) & (n["node_id"] <= a["last_id"])
        )

    def fallback(n: Column) -> Column:
        return (
            D.class_holds("bio")(n)
            | (n["tag"].isin("p", "div") & under(mains, n))
            | ((n["tag"] == "p") & under(prose, n))
        )

    tries.append(blank_to_null(D.text_of(body, D.first(dom, fallback))))
    return F.coalesce(*tries)


def prefix_word_text(dom: Column, body: Column) -> Column:
    """Remainder of the first element that is a prefix word and up to 199 more characters."""
    words = "|".join(ICON_PREFIXES)
    pattern = rf"(?i)^(?:{words})[{WS}]++([^\r\n]+)$"
    # A long element may match if it is mostly white space: its beginning says so,
    # blank so far, the prefix word and white space, or perhaps a part of the word.
    head = rf"(?i)^[{WS}]*+(?:(?:{words})[{WS}]|[a-z]{{0,9}}$)"
    possible = F.filter(
        dom,
        lambda n: (n["t1"] - n["t0"] <= 256) | F.substring(body, n["t0"] + 1, F.lit(64)).rlike(head),
    )
    rest = F.transform(possible, lambda n: F.regexp_extract(D.text_of(body, n), pattern, 1))
    return trim_ws(
        F.get(F.filter(rest, lambda t: F.length(t).between(1, 199)), F.lit(0))
    )


# -- names -------------------------------------------------------------------


def name_heading_first(dom: Column, body: Column) -> Column:
    return F.coalesce(heading_text(dom, body), tag_text(dom, body, "h1"))


def name_h1_first(dom: Column, body: Column) -> Column:
    return F.coalesce(tag_text(dom, body, "h1"), heading_text(dom, body))


# -- e-mail and phone --------------------------------------------------------


def mailto_email(dom: Column, check_address: bool = False) -> Column:
    """Address of the first ``mailto:`` link only."""
    return email_from_mailto(
        D.attr(D.first(dom, D.link_starts("mailto:")), "href"), check_address
    )


def email_link_or_text(dom: Column, body: Column, max_chars: int | None = None) -> Column:
    return F.coalesce(mailto_email(dom), first_email(body, max_chars))


def email_link_or_written_out(dom: Column, body: Column) -> Column:
    return F.coalesce(mailto_email(dom, check_address=True), written_out_email(body))


def tel_phone(dom: Column, body: Column) -> Column:
    """Number of the first ``tel:`` link only."""
    return let(
        D.first(dom, D.link_starts("tel:")),
        lambda n: phone_from_tel(D.attr(n, "href"), D.text_of(body, n)),
    )


def phone_link_or_text(dom: Column, body: Column, max_chars: int | None = None) -> Column:
    return F.coalesce(tel_phone(dom, body), first_phone(body, max_chars))


def phone_from_links(dom: Column, body: Column, blocked: Sequence[str]) -> Column:
    return phone_from_tel_links(D.tel_links(dom, body), blocked)


# -- companies ---------------------------------------------------------------


def _company_like(text: Column) -> Column:
    return let(text, lambda t: F.when(is_company_like(t), t))


def _candidate(text: Column) -> Column:
    return let(text, lambda t: F.when(is_company_candidate(t), t))


def company_after_heading(dom: Column, body: Column) -> Column:
    """Line after the h1 or first heading, else the labelled value, else a class name."""

    def line_after(node: Column) -> Column:
        return let(
            node,
            lambda n: _company_like(first_line(D.text_of(body, D.next_sibling(dom, n)))),
        )

    return F.coalesce(
        line_after(D.first(dom, D.tag_in(["h1"]))),
        line_after(D.first(dom, D.tag_in(D.HEADINGS))),
        _company_like(label_sibling_text(dom, body, "Company")),
        *[
            _company_like(D.text_of(body, D.first(dom, D.class_holds(name))))
            for name in ("company", "firm", "brokerage")  # fixed values
        ],
    )


def company_h2_or_label(dom: Column, body: Column) -> Column:
    return F.coalesce(
        let(tag_text(dom, body, "h2"), company_heading),
        let(
            label_sibling_text(dom, body, "Company"),
            lambda t: F.when(F.length(t) < 200, t),
        ),
    )


def company_by_icon(dom: Column, body: Column) -> Column:
    """Next to a building icon, else the icon's parent, a prefix word, or the labelled value."""

    def short(text: Column) -> Column:
        return let(blank_to_null(text), lambda t: F.when(F.length(t) <= 200, t))

    def beside(n: Column) -> Column:
        return F.coalesce(
            short(D.text_of(body, D.next_sibling(dom, n))),
            let(
                short(D.text_of(body, D.parent(dom, n))),
                lambda t: without_prefix_word(t, ICON_PREFIXES),
            ),
        )

    return F.coalesce(
        let(D.first(dom, _ICON), beside),
        prefix_word_text(dom, body),
        label_sibling_text(dom, body, "Company"),
    )


def company_near_location(dom: Column, body: Column) -> Column:
    """Line above the first city and state: of the page, then around the pin, logo and label."""

    def around_pin(n: Column) -> Column:
        up = D.parent(dom, n)

        def block_before(text: Column) -> Column:
            return F.coalesce(_candidate(first_line(text)), _candidate(text))

        return F.coalesce(
            line_above_location(D.text_of(body, up)),
            _candidate(D.text_of(body, D.previous_sibling(dom, n))),
            let(up, lambda p: line_above_location(D.text_of(body, D.parent(dom, p)))),
            let(
                let(up, lambda p: D.text_of(body, D.previous_sibling(dom, p))),
                block_before,
            ),
        )

    logo_holders = F.filter(dom, D.class_holds("logo"))

    def is_logo(n: Column) -> Column:
        image = (n["tag"] == "img") & (
            D.class_holds("logo")(n)
            | D.attr_holds("alt", "logo", ignore_case=True)(n)
            | D.attr_holds("src", "logo")(n)
            | F.exists(
                logo_holders,
                lambda a: (a["node_id"] < n["node_id"]) & (n["node_id"] <= a["last_id"]),
            )
        )
        return image | D.class_holds("company-logo")(n)

    def around_logo(n: Column) -> Column:
        return F.coalesce(
            F.get(
                F.filter(
                    text_lines(D.text_of(body, D.parent(dom, n))),
                    lambda line: is_company_candidate(line),
                ),
                F.lit(0),
            ),
            _candidate(D.text_of(body, D.next_sibling(dom, n))),
        )

    return F.coalesce(
        line_above_location(body),
        let(F.coalesce(D.first(dom, _PIN), D.first(dom, _PLACE)), around_pin),
        let(D.first(dom, is_logo), around_logo),
        let(
            label_sibling_text(dom, body, "Company"),
            lambda t: F.when(F.length(t).between(2, 199), t),
        ),
    )


# -- locations ---------------------------------------------------------------


def location_from_labels(
    dom: Column, body: Column, rule: LocationRule, labels: Sequence[str]
) -> Column:
    """Around the address labels, parent then sibling, else the main text."""
    scopes = []
    for label in labels:
        scopes.append(label_parent_text(dom, body, label))
        scopes.append(label_sibling_text(dom, body, label))
    scopes.append(main_or_body_text(dom, body))
    return first_location(F.array(*scopes), rule)


def location_from_pin(dom: Column, body: Column, rule: LocationRule) -> Column:
    """Around the pin icon as it stands, then a place block, then the whole page."""
    scopes = F.array(
        let(D.first(dom, _PIN), lambda n: D.text_of(body, D.parent(dom, n))),
        let(D.first(dom, _PIN), lambda n: D.text_of(body, D.next_sibling(dom, n))),
        D.text_of(body, D.first(dom, _PLACE)),
        squeeze_ws(body),
    )
    as_is = LocationRule(title=rule.title, strict=rule.strict, squeeze=False)
    return first_location(scopes, as_is)


def location_from_main(dom: Column, body: Column, rule: LocationRule) -> Column:
    return find_location(main_or_body_text(dom, body), rule)
