"""A whole source: pages in, contact records out.

Two narrow branches meet on ``url``. The profile branch tests keywords on
every page inside the scan stage, parses only the pages that may match and
reads the fields; the frontier branch reads only directory pages. Neither
shuffles ``html``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from contactmine.functions import dom as D, fields as X
from contactmine.functions.emails import first_allowed_email
from contactmine.functions.keywords import (
    keyword_hits,
    keyword_note,
    may_hold_keyword,
    merge_hits,
)
from contactmine.functions.listings import (
    combined_text,
    first_match,
    in_listing_order,
    listing_hits,
    listing_note,
)
from contactmine.functions.phones import first_allowed_phone
from contactmine.functions.records import parse_card
from contactmine.functions.text import visible_text
from contactmine.functions.urls import resolve_url
from contactmine.operators import contacts as C, frontier as U
from contactmine.operators.listings import page_listings
from contactmine.operators.matching import staged
from contactmine.plans.profiles import ADDRESS_LABELS, BIO_LABELS, SourceProfile
from contactmine.schema import CONTACT_FIELDS
from contactmine.sources.dom import parse_pages
from contactmine.sources.pages import with_final_url

# Blocks that may be a listing card, and the link inside it.
CARD_BLOCKS = ["div", "article", "li", "section"]
CARD_LINK = r"(?i)more\s+details\s*»?"


def extract_contacts(
    pages: DataFrame, profile: SourceProfile, keep_all: bool = False
) -> DataFrame:
    """Contact fields of every page that matches; other columns but ``html`` stay.

    Narrow from end to end: no shuffle, one Python step on the pages that may
    match. With ``keep_all`` pages that do not match stay, with a NULL
    ``source_url`` and no fields.
    """
    if profile.final_url_holds:
        landed = F.contains("final_url", F.lit(profile.final_url_holds))
        pages = _narrow(with_final_url(pages), landed, keep_all)
    readers = {
        "tabs": _read_tabs,
        "state_page": _read_state_page,
        "cards": _read_cards,
        "listings": _read_listings,
    }
    return readers[profile.layout](pages, profile, keep_all)


def _narrow(pages: DataFrame, condition: Column, keep_all: bool) -> DataFrame:
    """Rows that pass, or all rows with the html of the others dropped."""
    if keep_all:
        return pages.withColumn("html", F.when(condition, F.col("html")))
    return pages.filter(condition)


def _body_matches(pages: DataFrame, profile: SourceProfile, keep_all: bool) -> DataFrame:
    """Pages whose visible text has a keyword, parsed."""
    tested = pages.withColumn("_shown", visible_text(F.col("html")))
    tested = staged(tested, hits=keyword_hits(F.col("_shown"), profile.keywords))
    return parse_pages(_narrow(tested, F.size("hits") > 0, keep_all).drop("_shown"))


def _possible_matches(pages: DataFrame, profile: SourceProfile, keep_all: bool) -> DataFrame:
    """Pages that hold all words of some keyword, parsed; the real test comes after."""
    tested = pages.withColumn("_shown", visible_text(F.col("html")))
    tested = staged(
        tested, _possible=may_hold_keyword(F.col("_shown"), profile.keywords)
    )
    return parse_pages(
        _narrow(tested, F.col("_possible"), keep_all).drop("_shown", "_possible")
    )


def _matched(df: DataFrame, keep_all: bool) -> DataFrame:
    return df if keep_all else df.filter(F.size("hits") > 0)


def _record(parsed: DataFrame, **fields: Column) -> DataFrame:
    scratch = {"body_text", "dom", "listings", "_bio", "_all_text", "_match"}
    kept = [c for c in parsed.columns if c not in scratch and c not in fields]
    return parsed.select(
        *kept, *[value.alias(name) for name, value in fields.items()]
    ).withColumn("source_url", F.when(F.size("hits") > 0, F.col("url")))


def _read_tabs(pages: DataFrame, profile: SourceProfile, keep_all: bool) -> DataFrame:
    dom, body = F.col("dom"), F.col("body_text")
    return _record(
        _body_matches(pages, profile, keep_all),
        full_name=X.name_heading_first(dom, body),
        phone_number=X.tel_phone(dom, body),
        location=X.location_from_labels(dom, body, profile.location, ADDRESS_LABELS),
        company=X.company_after_heading(dom, body),
        email=X.mailto_email(dom),
        notes=keyword_note(F.col("hits")),
    )


def _read_state_page(pages: DataFrame, profile: SourceProfile, keep_all: bool) -> DataFrame:
    dom, body = F.col("dom"), F.col("body_text")
    return _record(
        _body_matches(pages, profile, keep_all),
        full_name=X.tag_text(dom, body, "h1"),
        phone_number=X.phone_link_or_text(dom, body),
        location=X.find_location(body, profile.location),
        company=X.company_h2_or_label(dom, body),
        email=X.email_link_or_text(dom, body),
        notes=keyword_note(F.col("hits")),
    )


def _read_cards(pages: DataFrame, profile: SourceProfile, keep_all: bool) -> DataFrame:
    dom, body = F.col("dom"), F.col("body_text")
    parsed = _possible_matches(pages, profile, keep_all).withColumn(
        "_bio", X.labelled_block(dom, body, BIO_LABELS)
    )
    matched = staged(parsed, hits=keyword_hits(F.col("_bio"), profile.keywords))
    return _record(
        _matched(matched, keep_all),
        full_name=X.heading_text(dom, body),
        phone_number=X.phone_from_links(dom, body, profile.blocked_phones),
        location=X.location_from_main(dom, body, profile.location),
        company=X.label_sibling_text(dom, body, "Company"),
        email=X.email_link_or_written_out(dom, body),
        notes=keyword_note(F.col("hits")),
    )


def _read_listings(pages: DataFrame, profile: SourceProfile, keep_all: bool) -> DataFrame:
    dom, body = F.col("dom"), F.col("body_text")
    parsed = _possible_matches(pages, profile, keep_all).withColumn(
        "listings", in_listing_order(page_listings(dom, body))
    )
    hits = merge_hits(
        keyword_hits(body, profile.keywords),
        listing_hits(F.col("listings"), profile.keywords),
    )
    matched = _matched(staged(parsed, hits=hits), keep_all).withColumns(
        {
            "_match": first_match(F.col("listings"), profile.keywords),
            "_all_text": combined_text(body, F.col("listings")),
        }
    )
    everything = F.col("_all_text")
    return _record(
        matched,
        full_name=X.name_h1_first(dom, body),
        phone_number=first_allowed_phone(everything, profile.blocked_phones),
        location=X.location_from_pin(dom, body, profile.location),
        company=X.company_near_location(dom, body),
        email=first_allowed_email(everything, profile.blocked_emails),
        notes=listing_note(
            F.col("_match.match_source"), F.col("_match.matched_type"), F.col("hits")
        ),
    )


def directory_cards(pages: DataFrame, *keys: str) -> DataFrame:
    """``pos, url, card_name, card_company, card_phone`` of each details link on a directory page."""
    dom, body = F.col("dom"), F.col("body_text")
    links = F.filter(
        dom,
        lambda n: (n["tag"] == "a") & F.coalesce(D.text_of(body, n).rlike(CARD_LINK), F.lit(False)),
    )
    cards = F.transform(
        links,
        lambda n: F.struct(
            D.attr(n, "href").alias("href"),
            parse_card(D.text_of(body, D.nearest_ancestor(dom, n, CARD_BLOCKS))).alias("card"),
        ),
    )
    parsed = parse_pages(pages.select(*keys, F.col("url").alias("_page_url"), "html"))
    rows = parsed.select(*keys, "_page_url", F.posexplode(cards).alias("pos", "c"))
    return rows.filter(F.coalesce(F.col("c.href"), F.lit("")) != "").select(
        *keys,
        "pos",
        resolve_url(F.col("_page_url"), F.col("c.href")).alias("url"),
        F.col("c.card.name").alias("card_name"),
        F.col("c.card.company").alias("card_company"),
        F.col("c.card.phone").alias("card_phone"),
    )


def build_frontier(directory: DataFrame, profile: SourceProfile) -> DataFrame:
    """Profile URLs to visit: ``region, region_ord, page_num, pos, url`` and card texts.

    ``directory``: landed directory pages with ``region, region_ord, page_num,
    url, html``.
    """
    keys = ["region", "region_ord", "page_num"]
    order = ["region_ord", "page_num", "pos"]
    if profile.max_pages is not None or profile.start_page > 1:
        directory = U.page_range(directory, profile.start_page, profile.max_pages)
    if profile.layout == "cards":
        carried = ["card_name", "card_company"]
        rows = directory_cards(directory, *keys)
    else:
        carried = []
        linked = U.profile_links(
            U.page_links(directory, profile.any_element_links),
            profile.url_pattern,
            profile.min_slug,
            profile.excluded_urls,
            profile.skip_links,
        )
        rows = U.frontier_rows(linked, *keys)
    seen = U.first_seen(rows, ["region"], [*order, *carried])
    if profile.stop_when_nothing_new:
        by_page = U.novelty(seen, directory, ["region", "page_num"])
        stops = U.stop_pages(by_page, ["region", "page_num"])
        seen = U.until_stop(seen, stops, ["region", "page_num"])
    if "region" not in profile.seen_scope:
        seen = U.first_seen(seen, [], ["region_ord", "page_num", "pos", "region", *carried])
    return U.cap_per_group(seen, ["region"], profile.max_profiles)


def visit_order(profile: SourceProfile) -> Column:
    """What decides which of two equal contacts came first."""
    if profile.sorted_visits:
        return F.struct("region_ord", "url")
    return F.struct("region_ord", "page_num", "pos")


def collect_contacts(
    pages: DataFrame, directory: DataFrame, profile: SourceProfile
) -> DataFrame:
    """Contacts of the profiles a directory leads to, not yet normalised.

    ``url`` joins two narrow tables; the wide pages stay where they are.
    """
    found = extract_contacts(pages, profile)
    frontier = build_frontier(directory, profile)
    joined = found.join(frontier, "url")
    if profile.layout == "cards":
        joined = joined.withColumns(
            {
                "full_name": F.coalesce("card_name", "full_name"),
                "company": F.coalesce("card_company", "company"),
            }
        )
    return joined.select(
        F.lit(profile.name).alias("source"),
        "region",
        *CONTACT_FIELDS,
        visit_order(profile).alias("ingest_ord"),
    )


def clean_contacts(
    pages: DataFrame, directory: DataFrame, profile: SourceProfile
) -> DataFrame:
    """Normalised contacts, one per key."""
    return C.clean(collect_contacts(pages, directory, profile))
