"""The rules on small hand-made inputs, with results worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from contactmine.functions import companies, emails, keywords, listings, locations, phones, records, text, urls
from contactmine.operators import contacts as C, frontier as U
from contactmine.plans.profiles import SOURCE_A, SOURCE_B, SOURCE_C, WASH_KEYWORDS, limited
from dataclasses import replace

T = "t"


def col():
    return F.col(T)


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Express Car Wash for sale", "express car wash; car wash"),
        ("CARWASH and Tunnel Wash", "tunnel wash; carwash"),
        ("laundry", "N/A"),
        ("N/A", "N/A"),
        (None, "N/A"),
    ],
)
def test_keyword_notes(one, value, expected):
    made = lambda: keywords.keyword_note(keywords.keyword_hits(col(), WASH_KEYWORDS))
    assert one(made, t=value) == expected


def test_sentinel_holds_no_keyword(one):
    assert one(lambda: keywords.keyword_hits(col(), ["a", "n/a"]), t="N/A") == []
    assert one(lambda: keywords.keyword_hits(col(), ["a", "n/a"]), t="n/a") == ["a", "n/a"]


def test_keyword_hits_agree_inside_arrays(one):
    for value in ["Express Car Wash", "nothing", ""]:
        plain = one(lambda: keywords.keyword_hits(col(), WASH_KEYWORDS), t=value)
        item = one(lambda: keywords.keyword_hits_in_item(col(), WASH_KEYWORDS), t=value)
        assert plain == item


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Tampa, FL", "Tampa, FL"),
        ("Tampa,FL", "Tampa,FL"),
        (" Tampa, ZZ\t", "Tampa, ZZ"),
        ("Tampa, Florida", "N/A"),
        ("A, B, FL", "N/A"),
        (" ", "N/A"),
        (None, "N/A"),
        ("x" * 77 + ", FL", "N/A"),
        ("x" * 76 + ", FL", "x" * 76 + ", FL"),
    ],
)
def test_location_check(one, value, expected):
    assert one(lambda: records.checked_location(col()), t=value) == expected


def test_white_space(one):
    assert one(lambda: text.trim_ws(col()), t=" \t a b\n　") == "a b"
    assert one(lambda: text.squeeze_ws(col()), t=" a  b\n\n c ") == "a b c"
    assert one(lambda: text.text_lines(col()), t="a\n \n b \n") == ["a", "b"]
    assert one(lambda: text.text_or(col()), t=" \n") == "N/A"


@pytest.mark.parametrize("value", ["ST. PETER'S-BY O'NEIL", "MIAMI BEACH", "É1B", "Tampa", "1A"])
def test_title_case_is_pythons(one, value):
    expected = value.title() if value.isupper() else value
    assert one(lambda: text.title_if_upper(col()), t=value) == expected


CONTACTS = [
    (1, "Ann Lee", "(813) 555-0101", "Gulf Group"),
    (2, "ann lee ", "813-555-0101", "GULF GROUP"),
    (3, "Ann Lee", "", "Gulf Group"),
    (4, "Ann Lee", None, "Gulf Group"),
    (5, "Ann Lee", "+1 813 555 0101", "Gulf Group"),
    (6, " ", "", None),
    (7, None, None, " "),
]


def contact_frame(spark, rows=CONTACTS):
    df = spark.createDataFrame(rows, "ingest_ord long, full_name string, phone_number string, company string")
    for name in ("location", "email", "source_url", "notes"):
        df = df.withColumn(name, F.lit(None).cast("string"))
    return df


def kept(df):
    return sorted(r["ingest_ord"] for r in df.select("ingest_ord").collect())


def test_dedup_keeps_first(spark):
    df = contact_frame(spark)
    assert kept(C.clean(df)) == [1, 3, 5, 6]
    assert kept(C.clean(df, fold_country_code=True)) == [1, 3, 6]
    assert kept(C.clean(df, keep_unidentified=True)) == [1, 3, 5, 6, 7]
    assert kept(C.clean(df.limit(0))) == []


def test_dedup_does_not_depend_on_layout(spark):
    df = contact_frame(spark)
    expected = kept(C.clean(df))
    for n in (1, 17):
        assert kept(C.clean(df.orderBy(F.desc("ingest_ord")).repartition(n))) == expected
    once = C.clean(df)
    assert kept(C.clean(once)) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Call 888-273-0423 or 8135550101", "8135550101"),
        ("8882730423 or 305-555-0199", "305-555-0199"),
        ("888-273-0423 then (305) 555-0199", None),
        ("+1 (813) 555-0101", "(813) 555-0101"),
        ("no phone", None),
    ],
)
def test_phone_patterns_in_order(one, value, expected):
    assert one(lambda: phones.first_allowed_phone(col(), ["8882730423"]), t=value) == expected


def test_first_email(one):
    blocked = ["support@site.example.com"]
    both = "support@site.example.com ann@example.com"
    assert one(lambda: emails.first_allowed_email(col(), blocked), t=both) is None
    assert one(lambda: emails.first_allowed_email(col(), blocked, scan_all=True), t=both) == "ann@example.com"
    joined = "a@b.co-x@y.com"
    every = lambda: emails.first_allowed_email(col(), ["a@b.co"], scan_all=True)
    assert one(every, t=joined) == "-x@y.com"
    assert one(lambda: emails.first_email(col(), 10), t="0123456789 ann@example.com") is None


@pytest.mark.parametrize(
    "value, expected, any_case",
    [
        ("mail ann [at] example [dot] com now", "ann@example.com", "ann@example.com"),
        ("ann(at)example(dot)com", "ann@example.com", "ann@example.com"),
        ("ann @ example . com", "ann@example.com", "ann@example.com"),
        ("ann [AT] example [DOT] com", None, "ann@example.com"),
        ("nobody", None, None),
    ],
)
def test_written_out_email(one, value, expected, any_case):
    assert one(lambda: emails.written_out_email(col()), t=value) == expected
    assert one(lambda: emails.written_out_email(col(), True), t=value) == any_case


def test_mailto(one):
    href = "mailto:ann@example.com?subject=hi"
    assert one(lambda: emails.email_from_mailto(col()), t=href) == "ann@example.com"
    only_query = "mailto:?cc=a@example.com"
    assert one(lambda: emails.email_from_mailto(col()), t=only_query) == ""
    assert one(lambda: emails.email_from_mailto(col(), True), t=only_query) is None


C_UNCUT = SOURCE_C.location
PLACES = [
    ("12 Main St\nMIAMI BEACH, FL 33101", "Main St MIAMI BEACH, FL", "Main St MIAMI BEACH, FL", "Main St MIAMI BEACH, FL"),
    ("12 / MIAMI BEACH, FL 33101", "MIAMI BEACH, FL", "Miami Beach, FL", "MIAMI BEACH, FL"),
    ("GULF GROUP 12 Main St. MIAMI BEACH, FL 33101",) + ("Main St. MIAMI BEACH, FL",) * 3,
    ("Suite 5 Tampa, Florida 33601",) + ("Tampa, FL",) * 3,
    ("Buffalo, New York 14201-0001",) + ("Buffalo, NY",) * 3,
    ("Tampa, Florida", "Tampa, FL", None, None),
    ("we met in the office, in Tampa", "we met in the office, in", "we met in the office, IN", "we met in the office, IN"),
    ("x" * 70 + ", FL 33101", None, None, None),
    ("foo, aaa bbb ccc ddd, Florida", None, None, None),
    ("Tampa, FL 33601",) + ("Tampa, FL",) * 3,
    ("A, FL 33601", None, None, None),
    ("le, le", "le, le", "le, LE", "le, LE"),
]


@pytest.mark.parametrize("value, a, b, c", PLACES)
def test_locations(one, value, a, b, c):
    assert one(lambda: locations.find_location(col(), SOURCE_A.location), t=value) == a
    assert one(lambda: locations.find_location(col(), SOURCE_B.location), t=value) == b
    assert one(lambda: locations.find_location(col(), C_UNCUT), t=value) == c


def test_location_options(one):
    strict = replace(SOURCE_A.location, strict=True)
    assert one(lambda: locations.find_location(col(), strict), t="le, le") is None
    long_text = "x; " * 700 + "Tampa, FL 33601"
    assert one(lambda: locations.find_location(col(), SOURCE_A.location), t=long_text) == "Tampa, FL"
    assert one(lambda: locations.find_location(col(), limited(SOURCE_A).location), t=long_text) is None
    late = "word. " * 30 + "9 Tampa, FL 33601"
    assert one(lambda: locations.find_location(col(), limited(SOURCE_C).location), t=late) is None
    assert one(lambda: locations.find_location(col(), C_UNCUT), t=late) == "Tampa, FL"


def test_state_code(one):
    assert one(lambda: locations.state_code(col()), t=" west VIRGINIA ") == "WV"
    assert one(lambda: locations.state_code(col()), t="zz") == "ZZ"
    assert one(lambda: locations.state_code(col(), strict=True), t="zz") is None
    assert one(lambda: locations.state_code(col()), t="Narnia") is None
    assert len(locations.STATES) == 51


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Former gas station, 2 acres", "Gas Station"),
        ("Two lots in Orlando", "Land"),
        ("Express Car Wash", "Car Wash"),
        ("QSR pad", "Qsr"),
        ("Former bakery", "Former Bakery"),
        ("Performer stage", ""),
        ("all former", ""),
    ],
)
def test_property_type(one, value, expected):
    assert one(lambda: listings.property_type(col()), t=value) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("Closed 2023", "Sold"), ("For lease", "Active"), ("Nice lot", "Active"), ("Sold and for sale", "Sold")],
)
def test_listing_status(one, value, expected):
    assert one(lambda: listings.listing_status(col()), t=value) == expected


@pytest.mark.parametrize(
    "source, type_, hits, expected",
    [
        ("Active", "Car Wash", ["car wash"], "Active: Car Wash — keywords: car wash"),
        ("Sold", "Property Listing", ["gas station", "slb"], "Sold: Gas Station — keywords: gas station; slb"),
        (None, None, ["slb"], "keywords: slb"),
        ("Sold", None, [], "Sold Listing Match"),
        (None, None, [], None),
    ],
)
def test_notes(spark, source, type_, hits, expected):
    df = spark.createDataFrame([(source, type_, hits)], "s string, t string, h array<string>")
    assert df.select(listings.listing_note(F.col("s"), F.col("t"), F.col("h"))).first()[0] == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Ann Lee\nGulf Group\n(813) 555-0101", ("Ann Lee", "Gulf Group", "(813) 555-0101")),
        ("Ann Lee\n(813) 555-0101", ("Ann Lee", None, "(813) 555-0101")),
        ("Ann Lee\nGulf Group", ("Ann Lee", "Gulf Group", None)),
        ("", (None, None, None)),
    ],
)
def test_card(one, value, expected):
    assert tuple(one(lambda: records.parse_card(col()), t=value)) == expected


def test_company_above_location(one):
    above = lambda: companies.line_above_location(col())
    assert one(above, t="Ann Lee\nGulf Group\nTampa, FL 33601") == "Gulf Group"
    estate = "Ann Lee\nGulf Real Estate Group\nTampa, FL 33601"
    assert one(above, t=estate) is None
    relaxed = lambda: companies.line_above_location(col(), word_boundary=True)
    assert one(relaxed, t=estate) == "Gulf Real Estate Group"
    assert one(above, t="Tampa, FL 33601\nGulf Group\nTampa, FL") is None


def test_page_numbers(one):
    url = lambda n: one(lambda: urls.directory_page_url(col(), F.lit(n)), t="https://h.example.com/d/")
    assert url(1) == "https://h.example.com/d/"
    assert url(2) == "https://h.example.com/d/page-2/"
    bare = one(lambda: urls.directory_page_url(col(), F.lit(1)), t="https://h.example.com/d")
    assert bare == "https://h.example.com/d/"


def test_resolve_is_urljoin(spark):
    from urllib.parse import urljoin

    hrefs = [
        "", "x", "./x", "../x", "../../../x", "/x//y", "x//y", "/a/./b/../c/", "?q=1", "#f", "//o.example.org/p",
        "http://o.example.org/a/../b", "mailto:a@example.com", "x/..", "..", ".", "x?y=/../z", "/", "/..", "/a//../b",
    ]
    bases = ["https://h.example.com/b/c/d?q=1#t", "https://h.example.com", "https://h.example.com/b/"]
    pairs = [(b, h) for b in bases for h in hrefs]
    df = spark.createDataFrame(pairs, "b string, h string")
    got = df.select("b", "h", urls.resolve_url(F.col("b"), F.col("h")).alias("u")).collect()
    assert {(r.b, r.h): r.u for r in got} == {(b, h): urljoin(b, h) for b, h in pairs}


def test_skip_first(spark):
    df = spark.createDataFrame([(["n1", "n2", "n3", "p1", "p2"],), (["n1", "n2", "n3"],), (["n1"],)], "a array<string>")
    got = [r[0] for r in df.select(urls.skip_first(F.col("a"), 3)).collect()]
    assert got == [["p1", "p2"], ["n1", "n2", "n3"], ["n1"]]


def test_stop_rule(spark):
    links = [(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (2, 0, "b"), (2, 1, "d"), (3, 0, "a"), (3, 1, "d"), (4, 0, "e")]
    rows = spark.createDataFrame([("r", *x) for x in links], "region string, page_num int, pos int, url string")
    keys = ["region", "page_num"]
    seen = U.first_seen(rows, ["region"])
    added = U.novelty(seen, rows, keys)
    assert sorted((r.page_num, r.added) for r in added.collect()) == [(1, 3), (2, 1), (3, 0), (4, 1)]
    totals = U.running_total(added, keys)
    assert sorted((r.page_num, r.total) for r in totals.collect()) == [(1, 3), (2, 4), (3, 4), (4, 5)]
    used = U.until_stop(seen, U.stop_pages(added, keys), keys)
    assert sorted(r.url for r in used.collect()) == ["a", "b", "c", "d"]


@pytest.mark.parametrize("n", [1, 5, 1200, None])
def test_cap_small_and_large(spark, n):
    rows = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'hot', 'r' || id % 7) region", "id div 4 page_num", "cast(id % 4 as int) pos", "cast(id as string) url"
    )
    got = U.cap_per_group(rows, ["region"], n).collect()
    assert len(set(got)) == len(got)
    groups = {}
    for r in rows.collect():
        groups.setdefault(r.region, []).append((r.page_num, r.pos, r.url))
    expected = {(g, *x) for g, xs in groups.items() for x in sorted(xs)[:n]}
    assert {(r.region, r.page_num, r.pos, r.url) for r in got} == expected


def test_running_sum_over_sparse_large_orders(spark):
    from contactmine.operators.prefix import running_sum

    data = [("g" if i % 3 else "h", (i * 7919) % 10007 * 10**9 + i, i % 5) for i in range(400)]
    df = spark.createDataFrame(data, "g string, o long, v long")
    got = {(r.g, r.o): r.total for r in running_sum(df, ["g"], "o", F.col("v")).collect()}
    expected, sums = {}, {}
    for g, o, v in sorted(data):
        sums[g] = sums.get(g, 0) + v
        expected[(g, o)] = sums[g]
    assert got == expected


def test_keyword_join_agrees_with_brute_force(spark):
    from contactmine.operators.matching import keyword_join, keyword_semi

    texts = ["The Tunnel wash", "a slb deal", "été, CARWASH", "", "car  wash", None]
    words = ["tunnel wash", "SLB", "s", "carwash", "été", "car wash", ""]
    t = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    k = spark.createDataFrame(list(enumerate(words)), "ord int, kw string")
    got = {(r.id, r.kw) for r in keyword_join(t, k, "id", "text").collect()}
    expected = {(i, w) for i, x in enumerate(texts) for w in words if x and w and w.lower() in x.lower()}
    assert got == expected
    semi = {r.id for r in keyword_semi(t, k, "id", "text").collect()}
    assert semi == {i for i, _ in expected}
    assert keyword_join(t, k.limit(0), "id", "text").count() == 0


def test_keyword_join_beyond_one_automaton(spark, monkeypatch):
    """Lists too long for one automaton give the same pairs; long keywords and texts are read whole."""
    from contactmine.operators import matching

    long = "the end of a very long keyword " * 40
    texts = [(1, "x" * 5000 + long.upper() + "!"), (2, "a car wash, a CAR"), (3, None), (4, ""), (5, long[:-2]), (2, "car")]
    words = [(1, "car"), (2, "Car Wash"), (3, long), (4, ""), (5, "zebra"), (6, "CAR")]
    t = spark.createDataFrame(texts, "id long, text string")
    k = spark.createDataFrame(words, "ord int, kw string")
    want = {(i, w) for i, x in texts for _, w in words if x and w and w.lower() in x.lower()}
    for chars in (matching.AUTOMATON_CHARS, 3):
        monkeypatch.setattr(matching, "AUTOMATON_CHARS", chars)
        rows = [(r.id, r.kw) for r in matching.keyword_join(t, k, "id", "text").collect()]
        assert set(rows) == want and len(rows) == len(want)
        assert {r.id for r in matching.keyword_semi(t, k, "id", "text").collect()} == {i for i, _ in want}
