"""The element tree, the fields read from it, and whole sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sqltext as S
from catalog.base import query, table, view
from contactmine.functions import dom as D, fields as X
from contactmine.functions.emails import first_email
from contactmine.functions.keywords import keyword_hits, keyword_note
from contactmine.functions.listings import (
    combined_text,
    first_match,
    in_listing_order,
    listing_hits,
)
from contactmine.functions.phones import first_allowed_phone
from contactmine.functions.text import text_or, visible_text
from contactmine.operators import contacts as C, listings as L, quality as Q
from contactmine.operators.matching import with_hits
from contactmine.plans.contacts import clean_contacts, directory_cards, extract_contacts
from contactmine.plans.profiles import (
    ADDRESS_LABELS,
    BIO_LABELS,
    HEADER_PHONE_C,
    PROPERTY_KEYWORDS,
    SOURCE_A,
    SOURCE_B,
    SOURCE_C,
    source_d,
)
from contactmine.schema import CONTACT_FIELDS
from contactmine.sources.dom import nodes_table, parse_pages
from contactmine.sources.pages import with_final_url

HOST = "h.example.com"


def _parsed(spark, sf_dir, name="fx_profiles"):
    return parse_pages(view(spark, sf_dir, name).select("page_id", "url", "html"))


def _field(name, sql, make, pages="fx_profiles"):
    """A query with one field per page; ``make(dom, body)`` gives its column."""

    def run(spark, sf_dir):
        return _parsed(spark, sf_dir, pages).select(
            "page_id", make(F.col("dom"), F.col("body_text")).alias("value")
        )

    query(name, sql and f"SELECT k AS page_id, {sql} AS value FROM {{fx_blocks}}")(run)


# -- the flagship ------------------------------------------------------------

SEARCH_WORDS = ["free", "licen", "ation"]


@query(
    "contact_search",
    f"""WITH t AS (SELECT page_id, url, html, {S.visible('html')} AS shown FROM {{pages}}),
        h AS (SELECT *, {S.hits('shown', SEARCH_WORDS)} AS hits FROM t),
        x AS (SELECT page_id, url AS source_url, array_to_string(hits, '; ') AS notes,
          coalesce(nullif({S.visible("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")}, ''), 'N/A') AS full_name,
          coalesce(nullif({S.trim(f"regexp_extract(shown, '{S.PHONE}')")}, ''), 'N/A') AS phone_number,
          coalesce(nullif(regexp_extract(shown, '{S.EMAIL}'), ''), 'N/A') AS email FROM h WHERE len(hits) > 0)
        SELECT page_id, full_name, phone_number, 'N/A' AS location, 'N/A' AS company, email, source_url, notes
        FROM (SELECT *, row_number() OVER (PARTITION BY lower(full_name) || '|' || regexp_replace(phone_number, '[^0-9]', '', 'g')
          ORDER BY page_id) AS rn FROM x) y WHERE rn = 1""",
)
def _(spark, sf_dir):
    """Which pages mention any of the keywords, and what contact details do they hold?"""
    pages = table(spark, sf_dir, "pages").withColumn("shown", visible_text(F.col("html")))
    heading = F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    contacts = with_hits(pages, "shown", SEARCH_WORDS).select(
        "page_id",
        visible_text(heading).alias("full_name"),
        first_allowed_phone(F.col("shown")).alias("phone_number"),
        F.lit(None).cast("string").alias("location"),
        F.lit(None).cast("string").alias("company"),
        first_email(F.col("shown")).alias("email"),
        F.col("url").alias("source_url"),
        keyword_note(F.col("hits")).alias("notes"),
    )
    return C.clean(contacts, order="page_id")


# -- the tree ----------------------------------------------------------------


@query(
    "node_counts",
    """SELECT page_id, tag, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(
          regexp_replace(html, '(?is)<!--.*?-->|(<script>).*?(</script>)', '\\1\\2', 'g'), '<([a-z0-9]+)[^>]*>', 1)) AS tag FROM {pages}) x
       GROUP BY page_id, tag""",
)
def _(spark, sf_dir):
    nodes = nodes_table(_parsed(spark, sf_dir, "pages"))
    return nodes.groupBy("page_id", "tag").agg(F.count("*").alias("n"))


@query(
    "page_lines_from_tree",
    f"SELECT page_id, {S.visible('html')} AS shown FROM {{fx_profiles}}",
)
def _(spark, sf_dir):
    return _parsed(spark, sf_dir).select("page_id", F.col("body_text").alias("shown"))


@query(
    "list_items",
    """SELECT k AS page_id, CAST(i AS INT) AS sib_ord, CASE i WHEN 0 THEN 'Company' ELSE holding END AS text
       FROM {fx_blocks}, range(0, 2) t(i)""",
)
def _(spark, sf_dir):
    nodes = nodes_table(_parsed(spark, sf_dir))
    return nodes.filter(F.col("tag") == "li").select("page_id", "sib_ord", "text")


_H1 = "CASE WHEN k % 11 <> 0 THEN name END"
_H2 = "CASE k % 3 WHEN 0 THEN 'Company Overview' WHEN 1 THEN seg || ' LLC' END"
_PLACE = "city || ', ' || st_code || ' ' || zip"
_SIBLING = "CASE WHEN k % 3 = 0 THEN nullif(phones, '') ELSE holding END"

# One of the segments is itself a prefix word.
_PREFIXED = """CASE WHEN seg = 'BUILDING' AND k % 4 = 1 THEN 'Group' WHEN k % 3 = 0 THEN 'Overview'
    WHEN seg = 'BUILDING' AND k % 3 = 1 THEN 'LLC' ELSE holding END"""

_field("first_h1", _H1, lambda dom, body: X.tag_text(dom, body, "h1"))
_field(
    "first_heading",
    f"coalesce({_H1}, {_H2}, 'About')",
    lambda dom, body: X.heading_text(dom, body),
)
_field(
    "class_select",
    "tagline",
    lambda dom, body: D.text_of(body, D.first(dom, D.class_holds("tag"))),
)
_field(
    "link_prefix",
    "CASE WHEN k % 4 = 1 THEN 'mailto:' || email || '?subject=hi' WHEN k % 4 = 2 THEN 'mailto:nobody' END",
    lambda dom, body: D.attr(D.first(dom, D.link_starts("mailto:")), "href"),
)
_field(
    "label_sibling",
    _SIBLING,
    lambda dom, body: X.label_sibling_text(dom, body, "company"),
)
_field(
    "previous_sibling",
    "coalesce(" + _H2 + ", tagline)",
    lambda dom, body: D.text_of(body, D.previous_sibling(dom, D.first(dom, D.has_class("phones")))),
)
_field(
    "parent_text",
    _PLACE,
    lambda dom, body: D.text_of(body, D.parent(dom, D.first(dom, D.class_holds("pin")))),
)
_field(
    "grandparent_tag",
    "CASE WHEN k % 5 = 0 THEN NULL ELSE 'body' END",
    lambda dom, body: D.parent(
        dom, D.parent(dom, D.first(dom, D.link_starts("tel:")))
    )["tag"],
)
_field(
    "block_ancestor",
    "CASE WHEN k % 5 <> 0 THEN 'phones' WHEN k % 4 IN (1, 2) THEN 'mails' END",
    lambda dom, body: D.nearest_ancestor(
        dom, D.first(dom, D.any_of(D.link_starts("tel:"), D.link_starts("mailto:"))), ["div", "li"], within=4
    )["classes"],
)
_field(
    "following_element",
    _PLACE,
    lambda dom, body: D.text_of(body, D.following(dom, D.first(dom, D.tag_in(["ul"])))),
)
_field(
    "next_page_flag",
    "k % 6 IN (0, 2, 4)",
    lambda dom, body: Q.has_next_page(dom, body),
)
_field(
    "bio_block",
    "'About' || chr(10) || bio",
    lambda dom, body: X.labelled_block(dom, body, BIO_LABELS),
)
_field(
    "prefix_word",
    _PREFIXED,
    lambda dom, body: X.prefix_word_text(dom, body),
)


@query(
    "link_by_text",
    """SELECT k AS page_id, 0 AS pos, 'https://h.example.com/profile/customer-' || CAST(k AS STRING) AS url, name AS card_name,
          CASE WHEN k % 3 = 0 THEN seg || ' Group' WHEN k % 3 = 2 THEN NULL END AS card_company, p_fmt AS card_phone
       FROM {fx_people}""",
)
def _(spark, sf_dir):
    return directory_cards(view(spark, sf_dir, "fx_directory"), "page_id")


# -- page quality ------------------------------------------------------------


@query(
    "challenge_filter",
    f"""SELECT page_id FROM {{pages}} WHERE NOT (contains(lower(url), 'challenge') OR contains(lower(url), 'cf-browser-verification')
          OR contains(lower(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), 'cloudflare')
          OR contains(lower({S.visible('html')}), 'verify you are human') OR contains(lower({S.visible('html')}), 'performing security verification'))""",
)
def _(spark, sf_dir):
    html = F.col("html")
    challenged = Q.is_challenge(F.col("url"), Q.page_title(html), visible_text(html))
    return table(spark, sf_dir, "pages").filter(~challenged).select("page_id")


@query(
    "final_host",
    """SELECT page_id FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'https://elsewhere.example.org/' ELSE url END AS final_url
       FROM {pages}) x WHERE contains(final_url, '.example.com/')""",
)
def _(spark, sf_dir):
    moved = table(spark, sf_dir, "pages").withColumn(
        "final_url",
        F.when(F.col("page_id") % 3 == 0, F.lit("https://elsewhere.example.org/")).otherwise(F.col("url")),
    )
    return Q.landed_on(with_final_url(moved), ".example.com/").select("page_id")


# -- fields ------------------------------------------------------------------

_TEL = """CASE k % 5 WHEN 1 THEN '+1' || p10 WHEN 2 THEN p_fmt WHEN 3 THEN '18886864222' WHEN 4 THEN '12345' END"""
_TEL_C = "CASE k % 5 WHEN 1 THEN '+1' || p10 WHEN 2 THEN p_fmt WHEN 3 THEN p_fmt WHEN 4 THEN 'Office ' || p_fmt END"
_MAIL_A = "CASE WHEN k % 4 = 1 THEN email END"
_MAIL_B = "CASE WHEN k % 4 IN (1, 2) THEN email END"
_MAIL_C = "CASE WHEN k % 4 IN (1, 2) THEN email WHEN k % 4 = 3 THEN 'c' || CAST(k AS STRING) || '@example.com' END"
_LIKE_PHONES = "CASE WHEN k % 5 IN (1, 3, 4) THEN phones END"
_COMPANY_A = f"""CASE WHEN k % 11 <> 0 AND k % 4 = 1 THEN tagline
    WHEN k % 11 = 0 AND k % 3 = 2 THEN bio
    WHEN k % 11 = 0 AND k % 5 IN (1, 3, 4) THEN phones
    WHEN k % 3 = 0 THEN {_LIKE_PHONES} ELSE holding END"""
_COMPANY_B = f"CASE WHEN k % 3 = 1 THEN seg || ' LLC' ELSE {_SIBLING} END"
_COMPANY_D = "CASE WHEN k % 13 = 0 THEN 'Company' ELSE holding END"

_field("email_mailto", _MAIL_A, lambda dom, body: X.mailto_email(dom))
_field("email_link_or_text", _MAIL_B, lambda dom, body: X.email_link_or_text(dom, body))
_field("email_link_or_written_out", _MAIL_C, lambda dom, body: X.email_link_or_written_out(dom, body))
_field("phone_tel", _TEL, lambda dom, body: X.tel_phone(dom, body))
_field(
    "phone_tel_header",
    _TEL_C,
    lambda dom, body: X.phone_from_links(dom, body, [HEADER_PHONE_C]),
)
_field("name_chain", f"coalesce({_H1}, {_H2}, 'About')", lambda dom, body: X.name_h1_first(dom, body))
_field("company_after_heading", _COMPANY_A, lambda dom, body: X.company_after_heading(dom, body))
_field("company_h2_or_label", _COMPANY_B, lambda dom, body: X.company_h2_or_label(dom, body))
_field("company_by_icon", _PREFIXED, lambda dom, body: X.company_by_icon(dom, body))
_field("company_near_location", _COMPANY_D, lambda dom, body: X.company_near_location(dom, body))
_field(
    "location_from_pin",
    "CASE WHEN city = 'MIAMI BEACH' THEN 'Miami Beach' WHEN city = 'WINSTON-SALEM' THEN 'Winston-Salem' ELSE city END || ', ' || st_code",
    lambda dom, body: X.location_from_pin(dom, body, source_d(HOST).location),
)


@query(
    "location_scope_order",
    f"SELECT page_id, {S.location_a('shown')} AS location FROM (SELECT page_id, {S.visible('html')} AS shown FROM {{fx_profiles}}) x",
)
def _(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "page_id",
        X.location_from_labels(F.col("dom"), F.col("body_text"), SOURCE_A.location, ADDRESS_LABELS).alias("location"),
    )


@query("location_labelled", "SELECT k AS page_id, CASE k % 3 WHEN 2 THEN NULL ELSE city || ', ' || st_code END AS location FROM {fx_people}")
def _(spark, sf_dir):
    kind = F.col("k") % 3
    place = F.concat("city", F.lit(", "), "st_name", F.lit(" "), "zip")
    html = (
        F.when(kind == 0, F.concat(F.lit("<div><b>Address</b><i>7 "), place, F.lit("</i></div><p>Rome, IT 1</p>")))
        .when(kind == 1, F.concat(F.lit("<p>Nice, one</p><dl><dt>Location<dd>9 Road<dd></dl><div><u>Office</u><i>5 "), place, F.lit("</i></div>")))
        .otherwise(F.concat(F.lit("<p>City</p><p>"), "name", F.lit("</p>")))
    )
    pages = view(spark, sf_dir, "fx_people").select(F.col("k").alias("page_id"), html.alias("html"))
    return parse_pages(pages).select(
        "page_id",
        X.location_from_labels(F.col("dom"), F.col("body_text"), SOURCE_A.location, ADDRESS_LABELS).alias("location"),
    )


# -- listings on pages -------------------------------------------------------


def _with_listings(spark, sf_dir):
    return _parsed(spark, sf_dir, "fx_listing_pages").withColumn(
        "listings", in_listing_order(L.page_listings(F.col("dom"), F.col("body_text")))
    )


_CARD_TEXT = "CASE p_partkey % 3 WHEN 0 THEN 'corner gas station' WHEN 1 THEN 'nice lot' ELSE 'express car' END"
_CARD_TYPE = "CASE p_partkey % 3 WHEN 0 THEN 'Gas Station' WHEN 1 THEN p_type ELSE p_type END"
_PAGE_LISTINGS = f"""(SELECT p_partkey AS page_id, CAST(0 AS INT) AS pos, 'Active' AS status, 'the ' || p_name || ' site' AS title,
      {_CARD_TEXT} AS description, {_CARD_TYPE} AS type,
      'the ' || p_name || ' site ' || {_CARD_TEXT} || ' ' || lower(p_type) AS full_text FROM {{part}} WHERE p_partkey % 5 <> 0
    UNION ALL SELECT p_partkey, CAST(1 AS INT), 'Sold', 'car wash ' || lower(p_brand), '', 'Car Wash',
      'car wash ' || lower(p_brand) FROM {{part}} WHERE p_partkey % 5 <> 0
    UNION ALL SELECT p_partkey, CAST(2 AS INT), 'Sold', '', lower(t), 'Carwash', lower(t) FROM (
      SELECT p_partkey, 'A ' || p_name || ' carwash on a corner pad with plenty of room, sold last year' AS t FROM {{part}}
      WHERE p_partkey % 5 = 0) s) l"""


@query(
    "page_listings",
    f"SELECT page_id, pos, status, title, description, type, full_text FROM {_PAGE_LISTINGS}",
)
def _(spark, sf_dir):
    return L.listings_table(_with_listings(spark, sf_dir), "page_id")


@query(
    "page_listing_match",
    """SELECT p_partkey AS page_id, CASE WHEN p_partkey % 5 = 0 THEN 'Carwash' WHEN p_partkey % 3 = 0 THEN 'Gas Station' ELSE 'Car Wash' END AS matched_type,
          CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 3 = 0 THEN 'Active' ELSE 'Sold' END AS match_source,
          CASE WHEN p_partkey % 5 = 0 THEN 'carwash' WHEN p_partkey % 3 = 0 THEN 'gas station; car wash' ELSE 'car wash' END AS hits
       FROM {part}""",
)
def _(spark, sf_dir):
    rows = _with_listings(spark, sf_dir).select(
        "page_id",
        first_match(F.col("listings"), PROPERTY_KEYWORDS).alias("m"),
        listing_hits(F.col("listings"), PROPERTY_KEYWORDS).alias("h"),
    )
    return rows.select("page_id", "m.*", F.array_join("h", "; ").alias("hits"))


@query(
    "page_combined_text",
    """SELECT p_partkey AS page_id, p_name || chr(10) || 'Intro text' || chr(10) ||
          CASE WHEN p_partkey % 5 = 0 THEN 'Sold Listings' || chr(10) || t || chr(10) || 'Active Properties' || chr(10) || 'short ' || lower(t)
          ELSE 'Our picks' || chr(10) || 'The ' || p_name || ' site' || chr(10) || d || chr(10) || p_type || chr(10) || 'Closed deals' || chr(10)
            || 'Car Wash ' || p_brand || ' the ' || p_name || ' site ' || lower(d) || ' ' || lower(p_type) || ' car wash ' || lower(p_brand) END AS combined
       FROM (SELECT *, 'A ' || p_name || ' carwash on a corner pad with plenty of room, sold last year' AS t,
          CASE p_partkey % 3 WHEN 0 THEN 'Corner gas station' WHEN 1 THEN 'Nice lot' ELSE 'Express Car' END AS d FROM {part}) x""",
)
def _(spark, sf_dir):
    return _with_listings(spark, sf_dir).select(
        "page_id", combined_text(F.col("body_text"), F.col("listings")).alias("combined")
    )


# -- whole sources -----------------------------------------------------------


def _contact_columns(df):
    return C.normalise(df).select("page_id", *CONTACT_FIELDS)


def _na(x):
    return f"coalesce({x}, 'N/A')"


def _source_sql(name, phone, location, company, email, where, notes):
    return f"""SELECT k AS page_id, {_na(name)} AS full_name, {_na(phone)} AS phone_number,
          {_na(f"CASE WHEN length(loc) <= 80 THEN loc END")} AS location, {_na(company)} AS company, {_na(email)} AS email,
          p.url AS source_url, {notes} AS notes
        FROM {{fx_blocks}} b JOIN (SELECT page_id, url, shown, {location} AS loc FROM (
          SELECT page_id, url, {S.visible('html')} AS shown FROM {{fx_profiles}}) v) p ON p.page_id = k WHERE {where}"""


_WASH = "CASE k % 3 WHEN 0 THEN 'car wash' ELSE 'tunnel wash' END"
_NAMES = f"coalesce({_H1}, {_H2}, 'About')"


@query(
    "source_a",
    _source_sql(_NAMES, _TEL, S.location_a("shown"), _COMPANY_A, _MAIL_A, "k % 3 <> 1", _WASH),
)
def _(spark, sf_dir):
    return _contact_columns(extract_contacts(view(spark, sf_dir, "fx_profiles"), SOURCE_A))


_TEXT_PHONE = S.trim(f"regexp_extract(p.shown, '{S.PHONE}')")


@query(
    "source_b",
    _source_sql(
        _H1,
        f"coalesce({_TEL}, nullif({_TEXT_PHONE}, ''))",
        S.location_b("shown"),
        _COMPANY_B,
        _MAIL_B,
        "k % 3 <> 1",
        _WASH,
    ),
)
def _(spark, sf_dir):
    return _contact_columns(extract_contacts(view(spark, sf_dir, "fx_profiles"), SOURCE_B))


@query(
    "source_c",
    _source_sql(
        _NAMES,
        _TEL_C,
        S.location_c("shown"),
        _SIBLING,
        _MAIL_C,
        "k % 3 <> 1",
        "CASE k % 3 WHEN 0 THEN 'Car Wash' ELSE 'Tunnel Wash' END",
    ),
)
def _(spark, sf_dir):
    return _contact_columns(extract_contacts(view(spark, sf_dir, "fx_profiles"), SOURCE_C))


@query(
    "source_d",
    """SELECT p_partkey AS page_id, p_name AS full_name, 'N/A' AS phone_number, 'N/A' AS location, 'N/A' AS company, 'N/A' AS email,
          'https://h.example.com/profile/part-' || CAST(p_partkey AS STRING) AS source_url,
          CASE WHEN p_partkey % 5 = 0 THEN 'Sold: Carwash — keywords: carwash' WHEN p_partkey % 3 = 0 THEN 'Active: Gas Station — keywords: car wash; gas station'
            ELSE 'Sold: Car Wash — keywords: car wash' END AS notes FROM {part}""",
)
def _(spark, sf_dir):
    return _contact_columns(
        extract_contacts(view(spark, sf_dir, "fx_listing_pages"), source_d(HOST))
    )


@query(
    "crawl_c",
    """SELECT seg AS region, name AS full_name, email FROM (
         SELECT seg, name, CASE WHEN k % 4 IN (1, 2) THEN email WHEN k % 4 = 3 THEN 'c' || CAST(k AS STRING) || '@example.com' ELSE 'N/A' END AS email, k
         FROM {fx_people}) x WHERE k % 3 <> 1""",
)
def _(spark, sf_dir):
    directory = view(spark, sf_dir, "fx_directory").select(
        "region", F.lit(0).alias("region_ord"), F.col("page_id").alias("page_num"), "url", "html"
    )
    pages = view(spark, sf_dir, "fx_profiles")
    found = clean_contacts(pages, directory, SOURCE_C)
    return found.select("region", "full_name", text_or(F.col("email")).alias("email"))


@query(
    "wide_keyword_scope",
    f"""SELECT page_id, array_to_string({S.hits('shown', PROPERTY_KEYWORDS)}, '; ') AS hits
        FROM (SELECT page_id, {S.visible('html')} AS shown FROM {{fx_listing_pages}}) x""",
)
def _(spark, sf_dir):
    shown = view(spark, sf_dir, "fx_listing_pages").select(
        "page_id", visible_text(F.col("html")).alias("shown")
    )
    return shown.select(
        "page_id", F.array_join(keyword_hits(F.col("shown"), PROPERTY_KEYWORDS), "; ").alias("hits")
    )
