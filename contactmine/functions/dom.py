"""Moving around a page's element tree, inside the row.

``sources.dom.parse_pages`` gives each page an array ``dom`` whose index is the
element's place in document order, with the places of its parent, siblings and
last descendant. Every step here is then an array lookup: no join, no window,
no shuffle, and a page never leaves its task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from contactmine.functions.text import let, trim_ws

HEADINGS = ["h1", "h2", "h3", "h4", "h5", "h6"]

Test = Callable[[Column], Column]


def first(dom: Column, test: Test) -> Column:
    """First element in document order that passes the test."""
    return F.get(F.filter(dom, test), F.lit(0))


def at(dom: Column, place: Column) -> Column:
    return F.get(dom, place)


def text_of(body: Column, node: Column) -> Column:
    """Visible text of an element; short texts are stored, long ones cut from the page text."""
    return let(
        node,
        lambda n: F.coalesce(
            n["text"],
            trim_ws(F.substring(body, n["t0"] + 1, n["t1"] - n["t0"])),
        ),
    )


def attr(node: Column, name: str) -> Column:
    return F.try_element_at(node["attrs"], F.lit(name))


def tag_in(tags: Sequence[str]) -> Test:
    return lambda n: n["tag"].isin(list(tags))


def class_holds(*tokens: str) -> Test:
    def test(n: Column) -> Column:
        hit = F.lit(False)
        for token in tokens:
            hit = hit | F.contains(F.coalesce(n["classes"], F.lit("")), F.lit(token))
        return hit

    return test


def attr_holds(name: str, token: str, ignore_case: bool = False) -> Test:
    def test(n: Column) -> Column:
        value = F.coalesce(attr(n, name), F.lit(""))
        return F.contains(F.lower(value) if ignore_case else value, F.lit(token))

    return test


def has_class(token: str) -> Test:
    """The class list has exactly this name."""
    return lambda n: F.array_contains(
        F.split(F.coalesce(n["classes"], F.lit("")), r"\s+"), token
    )


def link_starts(prefix: str) -> Test:
    return lambda n: (n["tag"] == "a") & F.coalesce(
        attr(n, "href").startswith(prefix), F.lit(False)
    )


def link_holds(part: str) -> Test:
    return lambda n: (n["tag"] == "a") & F.coalesce(
        F.contains(attr(n, "href"), F.lit(part)), F.lit(False)
    )


def any_of(*tests: Test) -> Test:
    def test(n: Column) -> Column:
        hit = tests[0](n)
        for other in tests[1:]:
            hit = hit | other(n)
        return hit

    return test


def parent(dom: Column, node: Column) -> Column:
    return at(dom, node["parent_id"])


def next_sibling(dom: Column, node: Column) -> Column:
    return at(dom, node["next_id"])


def previous_sibling(dom: Column, node: Column) -> Column:
    return at(dom, node["prev_id"])


def following(dom: Column, node: Column) -> Column:
    """First element after the end of this one's subtree."""
    return at(dom, node["last_id"] + 1)


def descendants(dom: Column, node: Column) -> Column:
    return F.slice(dom, node["node_id"] + 2, node["last_id"] - node["node_id"])


def ancestors(dom: Column, node: Column) -> Column:
    """Outermost first."""
    return F.filter(
        F.slice(dom, F.lit(1), node["node_id"]),
        lambda a: a["last_id"] >= node["node_id"],
    )


def nearest_ancestor(
    dom: Column, node: Column, tags: Sequence[str], within: int | None = None
) -> Column:
    """Closest ancestor with one of the tags (at most ``within`` levels up), else the parent."""

    def wanted(a: Column) -> Column:
        ok = a["tag"].isin(list(tags))
        if within is not None:
            ok = ok & (node["depth"] - a["depth"] <= within)
        return ok

    return F.coalesce(
        F.try_element_at(F.filter(ancestors(dom, node), wanted), F.lit(-1)),
        parent(dom, node),
    )


def by_text(dom: Column, body: Column, label: str) -> Column:
    """First smallest element whose text holds the label, in any case.

    The elements around the label's first occurrence form one chain; its
    innermost member is the first smallest element of the page.
    """
    # The one letter whose lower case is longer than itself would shift all places after it.
    lowered = F.lower(F.translate(body, "\u0130", "\u0307"))
    place = F.instr(lowered, F.lit(label.lower()))
    return let(
        place,
        lambda p: F.when(
            p > 0,
            F.try_element_at(
                F.filter(
                    dom, lambda n: (n["t0"] < p) & (n["t1"] >= p - 1 + len(label))
                ),
                F.lit(-1),
            ),
        ),
    )


def tel_links(dom: Column, body: Column) -> Column:
    """``tel:`` links in page order as ``struct<href, text>``."""
    return F.transform(
        F.filter(dom, link_starts("tel:")),
        lambda n: F.struct(
            attr(n, "href").alias("href"), text_of(body, n).alias("text")
        ),
    )
