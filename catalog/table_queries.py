"""Contacts, reports, frontier and listings as relational queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sqltext as S
from catalog.base import query, table, view
from contactmine.functions.listings import (
    PROPERTY_TYPES,
    listing_note,
    matched_type,
    property_type,
)
from contactmine.functions.keywords import merge_hits
from contactmine.functions.urls import (
    PROFILE_URL_ASPX,
    PROFILE_URL_NUMBERED,
    holds_none_of,
    is_profile_url,
    profile_url_slug,
    resolve_url,
    skip_first,
    url_host,
)
from contactmine.functions.phones import first_phone
from contactmine.functions.emails import first_email
from contactmine.operators import contacts as C, frontier as U, listings as L, reports as R
from contactmine.operators.matching import with_hits
from contactmine.plans.profiles import PROPERTY_KEYWORDS
from contactmine.schema import CONTACT_FIELDS
from contactmine.sources.pages import region_table, select_directory, select_regions, single_page

# -- contacts ----------------------------------------------------------------


def _na(x):
    return f"coalesce(nullif({S.trim(x)}, ''), 'N/A')"


_LOCATION = (
    f"CASE WHEN length({S.trim('location')}) <= 80 AND regexp_matches({S.trim('location')}, "
    f"'^[^,]+,[{S.WS}]*[A-Za-z]{{2}}$') THEN {S.trim('location')} ELSE 'N/A' END"
)
_NORMAL = f"""(SELECT ingest_ord, source, region, {_na('full_name')} AS full_name, {_na('phone_number')} AS phone_number,
    {_LOCATION} AS location, {_na('company')} AS company, {_na('email')} AS email,
    {_na('source_url')} AS source_url, {_na('notes')} AS notes FROM {{fx_contacts}}) n"""
_KEY = "lower(full_name) || '|' || regexp_replace(phone_number, '[^0-9]', '', 'g') || '|' || lower(company)"


@query("sentinel_fill", f"SELECT * FROM {_NORMAL}")
def _(spark, sf_dir):
    return C.normalise(view(spark, sf_dir, "fx_contacts"))


@query("location_check", f"SELECT ingest_ord, location FROM {_NORMAL} WHERE location <> 'N/A'")
def _(spark, sf_dir):
    normal = C.normalise(view(spark, sf_dir, "fx_contacts"))
    return normal.select("ingest_ord", "location").filter(F.col("location") != "N/A")


@query(
    "strip_columns",
    f"""SELECT ingest_ord, {', '.join(f'{S.trim(c)} AS {c}' for c in CONTACT_FIELDS)} FROM {{fx_contacts}}""",
)
def _(spark, sf_dir):
    return C.strip_all(view(spark, sf_dir, "fx_contacts")).select("ingest_ord", *CONTACT_FIELDS)


@query(
    "labelled_columns",
    f"""SELECT full_name AS "Full Name", phone_number AS "Phone Number", email AS "Email Address",
          location AS "Location (City, State)", company AS "Company", source_url AS "URL",
          notes AS "Notes (Keywords Found)" FROM {_NORMAL}""",
)
def _(spark, sf_dir):
    return C.labelled(
        C.normalise(view(spark, sf_dir, "fx_contacts")),
        {"Notes (URL Link)": "Notes (Keywords Found)"},
    )


@query(
    "dedup_keys",
    f"""SELECT ingest_ord, {_KEY} AS dedup_key,
          CASE WHEN raw_phone = '' THEN lower({S.trim('raw_name')}) || '|' || lower({S.trim('raw_company')})
            ELSE lower({S.trim('raw_name')}) || '|' || regexp_replace(regexp_replace(raw_phone, '[^0-9]', '', 'g'), '^1(.{{10}})$', '\\1')
              || '|' || lower({S.trim('raw_company')}) END AS raw_key
        FROM {_NORMAL} JOIN (SELECT ingest_ord, coalesce(phone_number, '') AS raw_phone, coalesce(full_name, '') AS raw_name,
          coalesce(company, '') AS raw_company FROM {{fx_contacts}}) r USING (ingest_ord)""",
)
def _(spark, sf_dir):
    raw = view(spark, sf_dir, "fx_contacts")
    raw_keys = C.with_dedup_key(raw, fold_country_code=True).select(
        "ingest_ord", F.col("dedup_key").alias("raw_key")
    )
    keys = C.with_dedup_key(C.normalise(raw)).select("ingest_ord", "dedup_key")
    return keys.join(raw_keys, "ingest_ord")


@query(
    "dedup_first",
    f"""SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY ingest_ord) AS rn
        FROM {_NORMAL}) x WHERE rn = 1""",
)
def _(spark, sf_dir):
    return C.clean(view(spark, sf_dir, "fx_contacts"))


@query(
    "dedup_keep_unidentified",
    f"""SELECT ingest_ord FROM (SELECT ingest_ord, row_number() OVER (PARTITION BY {_KEY},
          CASE WHEN full_name = 'N/A' AND phone_number = 'N/A' AND company = 'N/A' THEN ingest_ord END
          ORDER BY ingest_ord) AS rn FROM {_NORMAL}) x WHERE rn = 1""",
)
def _(spark, sf_dir):
    return C.clean(view(spark, sf_dir, "fx_contacts"), keep_unidentified=True).select("ingest_ord")


@query(
    "dedup_per_source",
    f"""SELECT source, ingest_ord FROM (SELECT *, row_number() OVER (PARTITION BY source, {_KEY} ORDER BY ingest_ord) AS rn
        FROM {_NORMAL}) x WHERE rn = 1""",
)
def _(spark, sf_dir):
    return C.clean(view(spark, sf_dir, "fx_contacts"), scope=["source"]).select(
        "source", "ingest_ord"
    )


@query(
    "union_sources",
    """SELECT 'customers' AS source, k AS id, name AS full_name FROM {fx_people}
       UNION ALL SELECT 'suppliers' AS source, s_suppkey AS id, s_name AS full_name FROM {supplier}""",
)
def _(spark, sf_dir):
    people = view(spark, sf_dir, "fx_people").select(F.col("k").alias("id"), F.col("name").alias("full_name"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("full_name")
    )
    return C.union_sources({"customers": people, "suppliers": suppliers})


@query(
    "union_regions",
    "SELECT ingest_ord, source, region FROM {fx_contacts} WHERE source IN ('A', 'B', 'C')",
)
def _(spark, sf_dir):
    rows = view(spark, sf_dir, "fx_contacts").select("ingest_ord", "source", "region")
    return C.union_regions([rows.filter(F.col("source") == s) for s in ("A", "B", "C")])


@query(
    "masked_contacts",
    f"""SELECT ingest_ord, CASE WHEN email = 'N/A' THEN email ELSE sha256(email) END AS email,
          CASE WHEN phone_number = 'N/A' THEN phone_number ELSE sha256(phone_number) END AS phone_number FROM {_NORMAL}""",
)
def _(spark, sf_dir):
    return C.mask(C.normalise(view(spark, sf_dir, "fx_contacts"))).select(
        "ingest_ord", "email", "phone_number"
    )


# -- reports -----------------------------------------------------------------


@query(
    "matches_per_region",
    "SELECT source, region, count(*) AS matches FROM {fx_contacts} GROUP BY source, region",
)
def _(spark, sf_dir):
    return R.matches_per_region(view(spark, sf_dir, "fx_contacts"))


@query(
    "dedup_stats_rollup",
    f"""SELECT source, region, count(*) AS total, count(DISTINCT {_KEY}) AS after_dedup
        FROM {_NORMAL} GROUP BY ROLLUP (source, region)""",
)
def _(spark, sf_dir):
    return R.totals(C.normalise(view(spark, sf_dir, "fx_contacts")))


@query(
    "drop_counts",
    """SELECT count(*) FILTER (url NOT LIKE '%example%') AS redirected,
          count(*) FILTER (url LIKE '%example%' AND NOT contains(lower(html), 'ation')) AS no_keyword,
          count(*) FILTER (url LIKE '%example%' AND contains(lower(html), 'ation') AND html IS NULL) AS failed,
          count(*) FILTER (url LIKE '%example%' AND contains(lower(html), 'ation')) AS kept FROM {pages}""",
)
def _(spark, sf_dir):
    html = F.lower("html")
    return R.drop_counts(
        table(spark, sf_dir, "pages"),
        {
            "redirected": ~F.contains("url", F.lit("example")),
            "no_keyword": ~F.contains(html, F.lit("ation")),
            "failed": F.col("html").isNull(),
        },
    )


# -- frontier ----------------------------------------------------------------

_HREFS = r"""regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1)"""
_ROOT = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"
_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
_LINKS = f"""(SELECT region, page_num, CAST(i - 1 AS INT) AS pos, root || h AS url FROM (
    SELECT {_HOST} AS region, {_ROOT} AS root, page_id AS page_num, unnest({_HREFS}) AS h,
      generate_subscripts({_HREFS}, 1) AS i FROM {{pages}}) a) l"""
_FIRST = f"""(SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY region, url ORDER BY page_num, pos) AS rn
    FROM {_LINKS}) b WHERE rn = 1) f"""
_NOVEL = f"""(SELECT region, page_num, coalesce(added, 0) AS added FROM (SELECT {_HOST} AS region, page_id AS page_num FROM {{pages}}) p
    LEFT JOIN (SELECT region, page_num, count(*) AS added FROM {_FIRST} GROUP BY ALL) c USING (region, page_num)) v"""
_KEYS = ["region", "page_num"]


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").withColumns(
        {"region": url_host(F.col("url")), "page_num": F.col("page_id")}
    )


def link_rows(spark, sf_dir):
    return U.frontier_rows(U.page_links(_pages(spark, sf_dir)), *_KEYS)


def first_rows(spark, sf_dir):
    return U.first_seen(link_rows(spark, sf_dir), ["region"])


def _novel(spark, sf_dir):
    pages = _pages(spark, sf_dir).select(*_KEYS)
    return U.novelty(first_rows(spark, sf_dir), pages, _KEYS)


@query(
    "links",
    f"""SELECT page_id, url, CAST(i - 1 AS INT) AS pos, href FROM (SELECT page_id, url, unnest({_HREFS}) AS href,
          generate_subscripts({_HREFS}, 1) AS i FROM {{pages}}) a""",
)
def _(spark, sf_dir):
    return U.links_table(table(spark, sf_dir, "pages"))


@query("frontier_rows", f"SELECT region, page_num, pos, url FROM {_LINKS}")
def _(spark, sf_dir):
    return link_rows(spark, sf_dir)


@query(
    "url_resolve",
    """SELECT k, CASE k % 12 WHEN 0 THEN base WHEN 1 THEN 'http://x.example.org/a/../' || sk
          WHEN 2 THEN 'https://cdn.example.com/' || sk WHEN 3 THEN 'https://h.example.com/b/c/d?p=' || sk
          WHEN 4 THEN 'https://h.example.com/b/c/d?q=1#f' || sk WHEN 5 THEN 'https://h.example.com/' || sk || '?a=1#b'
          WHEN 6 THEN 'https://h.example.com/b/c/' || sk WHEN 7 THEN 'https://h.example.com/b/' || sk || '/'
          WHEN 8 THEN 'https://h.example.com/b/c/x/' || sk WHEN 9 THEN 'https://h.example.com/' || sk
          WHEN 10 THEN 'mailto:c' || sk || '@example.com' ELSE 'https://h.example.com/b/c/' END AS url
       FROM (SELECT k, CAST(k AS STRING) AS sk, 'https://h.example.com/b/c/d?q=1#top' AS base FROM {fx_people}) x""",
)
def _(spark, sf_dir):
    sk = F.col("k").cast("string")
    shapes = [
        F.lit(""),
        F.concat(F.lit("http://x.example.org/a/../"), sk),
        F.concat(F.lit("//cdn.example.com/"), sk),
        F.concat(F.lit("?p="), sk),
        F.concat(F.lit("#f"), sk),
        F.concat(F.lit("/"), sk, F.lit("?a=1#b")),
        sk,
        F.concat(F.lit("../"), sk, F.lit("/")),
        F.concat(F.lit("./x//y/../"), sk),
        F.concat(F.lit("../../../../"), sk),
        F.concat(F.lit("mailto:c"), sk, F.lit("@example.com")),
        F.lit("."),
    ]
    href = F.get(F.array(*shapes), (F.col("k") % 12).cast("int"))
    base = F.lit("https://h.example.com/b/c/d?q=1#top")
    return view(spark, sf_dir, "fx_people").select("k", resolve_url(base, href).alias("url"))


@query(
    "url_pattern",
    r"""SELECT k, k % 3 = 0 AND k % 2 = 0 AS numbered, k % 3 = 1 AS aspx, k % 3 = 2 AND k > 9 AS slug
        FROM {fx_people}""",
)
def _(spark, sf_dir):
    sk = F.col("k").cast("string")
    url = (
        F.when(F.col("k") % 6 == 0, F.concat(F.lit("https://h.example.com/Business-Broker/a/b/BW"), sk))
        .when(F.col("k") % 3 == 0, F.concat(F.lit("https://h.example.com/business-broker/a/BW"), sk))
        .when(F.col("k") % 3 == 1, F.concat(F.lit("https://h.example.com/brokers/ann-lee-"), sk, F.lit(".aspx")))
        .otherwise(F.concat(F.lit("https://h.example.com/profile/c"), sk))
    )
    return view(spark, sf_dir, "fx_people").select(
        "k",
        is_profile_url(url, PROFILE_URL_NUMBERED).alias("numbered"),
        is_profile_url(url, PROFILE_URL_ASPX).alias("aspx"),
        is_profile_url(url, profile_url_slug("h.example.com"), 3).alias("slug"),
    )


@query(
    "url_exclude",
    f"SELECT region, page_num, pos, url FROM {_LINKS} WHERE NOT contains(lower(url), 'the') AND NOT contains(lower(url), 'blog.')",
)
def _(spark, sf_dir):
    return link_rows(spark, sf_dir).filter(holds_none_of(F.col("url"), ["The", "blog."]))


@query("distinct_urls", f"SELECT DISTINCT url FROM {_LINKS}")
def _(spark, sf_dir):
    return U.distinct_urls(link_rows(spark, sf_dir))


@query("first_seen", f"SELECT region, url, page_num, pos FROM {_FIRST}")
def _(spark, sf_dir):
    return first_rows(spark, sf_dir)


@query(
    "first_seen_in_run",
    f"""SELECT url, min(page_num) AS page_num, CAST(arg_min(pos, page_num * 100000 + pos) AS INT) AS pos FROM {_LINKS} GROUP BY url""",
)
def _(spark, sf_dir):
    return U.first_seen(link_rows(spark, sf_dir))


@query("sorted_urls", f"SELECT DISTINCT url FROM {_LINKS} ORDER BY url")
def _(spark, sf_dir):
    return U.visit_order(U.distinct_urls(link_rows(spark, sf_dir)))


@query(
    "skip_top_n",
    f"""SELECT page_num, CAST(rn - 1 - CASE WHEN n > 3 THEN 3 ELSE 0 END AS INT) AS pos, url FROM (
          SELECT page_num, url, row_number() OVER (PARTITION BY page_num ORDER BY pos) AS rn,
            count(*) OVER (PARTITION BY page_num) AS n FROM (
            SELECT page_num, url, min(pos) AS pos FROM {_LINKS} GROUP BY page_num, url) u) x
        WHERE n <= 3 OR rn > 3""",
)
def _(spark, sf_dir):
    linked = U.page_links(_pages(spark, sf_dir)).withColumn(
        "links", skip_first(F.array_distinct("links"), 3)
    )
    return U.frontier_rows(linked, "page_num")


@query(
    "page_urls",
    """SELECT 'A' AS source, r_name AS region, CAST(n AS INT) AS page_num,
          'https://h.example.com/' || lower(r_name) || CASE WHEN n = 1 THEN '/' ELSE '/page-' || CAST(n AS STRING) || '/' END AS url
       FROM {region}, range(1, 61) t(n)""",
)
def _(spark, sf_dir):
    regions = table(spark, sf_dir, "region").select(
        F.lit("A").alias("source"),
        F.col("r_name").alias("region"),
        F.concat(F.lit("https://h.example.com/"), F.lower("r_name")).alias("url"),
        F.lit(1).alias("start_page"),
        F.lit(60).alias("max_pages"),
    )
    return U.directory_pages(regions)


@query("novelty", f"SELECT region, page_num, added FROM {_NOVEL}")
def _(spark, sf_dir):
    return _novel(spark, sf_dir)


@query(
    "running_total",
    f"""SELECT region, page_num, added, CAST(sum(added) OVER (PARTITION BY region ORDER BY page_num) AS BIGINT) AS total FROM {_NOVEL}""",
)
def _(spark, sf_dir):
    return U.running_total(_novel(spark, sf_dir), _KEYS)


@query(
    "stop_rule",
    f"""SELECT f.region, f.url, f.page_num, f.pos FROM {_FIRST}
        LEFT JOIN (SELECT region, min(page_num) AS stop FROM {_NOVEL} WHERE added <= 4 GROUP BY region) s USING (region)
        WHERE stop IS NULL OR f.page_num < stop""",
)
def _(spark, sf_dir):
    # The pages all link to something new; a page with under five new links counts as empty here.
    sparse = _novel(spark, sf_dir).withColumn(
        "added", F.when(F.col("added") > 4, F.col("added")).otherwise(0)
    )
    return U.until_stop(first_rows(spark, sf_dir), U.stop_pages(sparse, _KEYS), _KEYS)


@query(
    "page_range",
    f"SELECT region, page_num, pos, url FROM {_LINKS} WHERE page_num BETWEEN 21 AND 70",
)
def _(spark, sf_dir):
    return U.page_range(link_rows(spark, sf_dir), 21, 50)


def _cap_sql(n):
    return f"""SELECT region, url, page_num, pos FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY page_num, pos) AS r
        FROM {_FIRST}) x WHERE r <= {n}"""


@query("cap_per_region", _cap_sql(7))
def _(spark, sf_dir):
    return U.cap_per_group(first_rows(spark, sf_dir), ["region"], 7)


@query(
    "cap_per_customer_large",
    """SELECT seg, k, o_orderkey FROM (SELECT c_mktsegment AS seg, c_custkey AS k, o_orderkey,
          row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey, o_orderkey) AS r
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey) x WHERE r <= 1500""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    rows = rows.select(F.col("c_mktsegment").alias("seg"), F.col("c_custkey").alias("k"), "o_orderkey")
    return U.cap_per_group(rows, ["seg"], 1500, ("k", "o_orderkey"))


@query(
    "seen_anti",
    f"""SELECT region, url, page_num, pos FROM {_FIRST} WHERE url NOT IN (
          SELECT url FROM {_LINKS} WHERE page_num < 20)""",
)
def _(spark, sf_dir):
    earlier = link_rows(spark, sf_dir).filter(F.col("page_num") < 20)
    return U.skip_seen(first_rows(spark, sf_dir), earlier).select("region", "url", "page_num", "pos")


@query(
    "links_per_directory",
    f"SELECT region, count(DISTINCT url) AS links FROM {_LINKS} GROUP BY region",
)
def _(spark, sf_dir):
    return R.links_per_directory(link_rows(spark, sf_dir))


# -- sources -----------------------------------------------------------------

_DIRECTORIES = [
    ("A", "HOUSEHOLD", "https://h.example.com/state/household/", 1, 60),
    ("A", "MACHINERY", "https://h.example.com/state/machinery/", 21, 1),
]


@query(
    "regions_selected",
    """SELECT page_id, region, start_page, max_pages FROM {fx_directory}
       JOIN (SELECT 'MACHINERY' AS region, CAST(21 AS INT) AS start_page, CAST(1 AS INT) AS max_pages) d USING (region)""",
)
def _(spark, sf_dir):
    wanted = select_regions(region_table(spark, _DIRECTORIES), ["MACHINERY"])
    pages = view(spark, sf_dir, "fx_directory").select("page_id", "region")
    return pages.join(wanted.select("region", "start_page", "max_pages"), "region")


@query(
    "alternative_directory",
    """SELECT page_id, region FROM {fx_directory} WHERE region = 'HOUSEHOLD' AND page_id BETWEEN 1 AND 60
       UNION ALL SELECT page_id, region FROM {fx_directory} WHERE region = 'MACHINERY' AND page_id BETWEEN 21 AND 21""",
)
def _(spark, sf_dir):
    regions = region_table(spark, _DIRECTORIES)
    pages = view(spark, sf_dir, "fx_directory").select("page_id", "region")

    def pages_of(directory):
        last = F.col("start_page") + F.col("max_pages") - 1
        joined = pages.join(directory.select("region", "start_page", "max_pages"), "region")
        return joined.filter(F.col("page_id").between(F.col("start_page"), last)).select(
            "page_id", "region"
        )

    return pages_of(select_directory(regions)).union(
        pages_of(select_directory(regions, "MACHINERY"))
    )


@query(
    "landed_directory",
    """SELECT region, CAST(0 AS INT) AS region_ord, CAST(1 AS INT) AS page_num, url, html FROM {fx_directory}
       WHERE url = 'https://h.example.com/state/household/'""",
)
def _(spark, sf_dir):
    pages = view(spark, sf_dir, "fx_directory").select("page_id", "url", "html")
    return U.landed_directory(pages, region_table(spark, _DIRECTORIES))


@query(
    "single_page",
    "SELECT page_id, url, html FROM {pages} WHERE url = 'https://thther.example.org/en/685'",
)
def _(spark, sf_dir):
    return single_page(table(spark, sf_dir, "pages"), "https://thther.example.org/en/685")


# -- listings ----------------------------------------------------------------

def _type_sql(x):
    whens = " ".join(f"WHEN contains(lower({x}), '{t}') THEN '{t.title()}'" for t in PROPERTY_TYPES)
    word = rf"regexp_extract(lower({x}), '(?:^|\s)former\s+(\S+)', 1)"
    return f"(CASE {whens} WHEN {word} <> '' THEN 'Former ' || upper(({word})[1]) || ({word})[2:] ELSE '' END)"


_LISTINGS = f"""(SELECT page_id, pos, CASE WHEN regexp_matches(lower(full_raw || ' ' || parent_text), 'sold|closed|transaction')
      THEN 'Sold' ELSE 'Active' END AS status, lower(title) AS title, lower(description) AS description,
      CASE WHEN {_type_sql('full_raw')} <> '' THEN {_type_sql('full_raw')} ELSE type END AS type, lower(full_raw) AS full_text
    FROM (SELECT *, trim(title || ' ' || description || ' ' || type) AS full_raw FROM {{fx_cards}}) a WHERE full_raw <> '') g"""
_LISTING_KEYS = PROPERTY_KEYWORDS + ["widget", "anvil", "gear"]
_MATCHING = f"""(SELECT *, CASE WHEN type <> '' THEN type WHEN title <> '' THEN
      CASE WHEN {_type_sql('title')} <> '' THEN {_type_sql('title')} ELSE title END
      WHEN {_type_sql('description')} <> '' THEN {_type_sql('description')} ELSE 'Property Listing' END AS matched_type,
      row_number() OVER (PARTITION BY page_id ORDER BY status, pos) AS rn
    FROM {_LISTINGS} WHERE len({S.hits('full_text', _LISTING_KEYS)}) > 0) m"""
_HIT_LISTS = f"""(SELECT page_id, array_to_string(list(kw ORDER BY status, pos, i), '; ') AS hits FROM (
      SELECT page_id, kw, status, pos, i, row_number() OVER (PARTITION BY page_id, kw ORDER BY status, pos) AS rn FROM (
        SELECT page_id, status, pos, unnest({S.hits('full_text', _LISTING_KEYS)}) AS kw,
          generate_subscripts({S.hits('full_text', _LISTING_KEYS)}, 1) AS i FROM {_LISTINGS}) h1) h2
      WHERE rn = 1 GROUP BY page_id) h"""


def _listings(spark, sf_dir):
    return L.listing_rows(view(spark, sf_dir, "fx_cards"))


@query("listing_rows", f"SELECT page_id, pos, status, title, description, type, full_text FROM {_LISTINGS}")
def _(spark, sf_dir):
    return _listings(spark, sf_dir)


@query(
    "property_type",
    f"SELECT page_id, pos, {_type_sql('description')} AS type FROM {{fx_cards}}",
)
def _(spark, sf_dir):
    return view(spark, sf_dir, "fx_cards").select(
        "page_id", "pos", property_type(F.col("description")).alias("type")
    )


@query("listing_status", f"SELECT status, count(*) AS n FROM {_LISTINGS} GROUP BY status")
def _(spark, sf_dir):
    return _listings(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"))


@query(
    "first_listing_match",
    f"SELECT page_id, matched_type, status AS match_source FROM {_MATCHING} WHERE rn = 1",
)
def _(spark, sf_dir):
    return L.first_listing_match(_listings(spark, sf_dir), _LISTING_KEYS)


@query(
    "matched_type",
    f"SELECT page_id, pos, matched_type FROM {_MATCHING}",
)
def _(spark, sf_dir):
    rows = with_hits(_listings(spark, sf_dir), "full_text", _LISTING_KEYS)
    return rows.select(
        "page_id",
        "pos",
        matched_type(F.col("type"), F.col("title"), F.col("description")).alias("matched_type"),
    )


@query("listing_keywords", f"SELECT page_id, hits FROM {_HIT_LISTS}")
def _(spark, sf_dir):
    lists = L.listing_keyword_lists(_listings(spark, sf_dir), _LISTING_KEYS)
    return lists.select("page_id", F.array_join("hits", "; ").alias("hits"))


@query(
    "merged_keywords",
    f"""SELECT page_id, array_to_string(list_concat(['slb', 'gear'],
          list_filter(string_split(hits, '; '), lambda k: k NOT IN ('slb', 'gear'))), '; ') AS hits FROM {_HIT_LISTS}""",
)
def _(spark, sf_dir):
    lists = L.listing_keyword_lists(_listings(spark, sf_dir), _LISTING_KEYS)
    body = F.array(F.lit("slb"), F.lit("gear"))
    return lists.select("page_id", F.array_join(merge_hits(body, F.col("hits")), "; ").alias("hits"))


@query(
    "compose_notes",
    f"""SELECT page_id, status || ': ' || CASE WHEN lower(matched_type) IN ('active listings', 'active', 'property listing', 'listing match')
          THEN {S.title("string_split(hits, '; ')[1]")} ELSE matched_type END || ' — keywords: ' || hits AS notes
        FROM {_MATCHING} JOIN {_HIT_LISTS} USING (page_id) WHERE rn = 1""",
)
def _(spark, sf_dir):
    rows = _listings(spark, sf_dir)
    seen = L.keyword_sightings(rows, _LISTING_KEYS)
    return (
        L.first_listing_match(rows, _LISTING_KEYS, sightings=seen)
        .join(L.listing_keyword_lists(rows, _LISTING_KEYS, sightings=seen), "page_id")
        .select(
            "page_id",
            listing_note(F.col("match_source"), F.col("matched_type"), F.col("hits")).alias("notes"),
        )
    )


@query(
    "combined_text",
    f"""SELECT o_orderkey AS page_id, nullif({S.trim(f"regexp_extract(x, '{S.PHONE}')")}, '') AS phone_number,
          nullif(regexp_extract(x, '{S.EMAIL}'), '') AS email
        FROM (SELECT o_orderkey, o_orderpriority || ' ' || coalesce(listed, '') AS x FROM {{orders}} LEFT JOIN (
          SELECT page_id, string_agg(full_text, ' ' ORDER BY status, pos) AS listed FROM {_LISTINGS} GROUP BY page_id) t
          ON o_orderkey = page_id) y""",
)
def _(spark, sf_dir):
    bodies = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("page_id"), F.col("o_orderpriority").alias("body_text")
    )
    texts = L.combined_texts(bodies, _listings(spark, sf_dir))
    return texts.select(
        "page_id",
        first_phone(F.col("combined_text")).alias("phone_number"),
        first_email(F.col("combined_text")).alias("email"),
    )
