"""The element tree, the fields of a page, and pages that misbehave."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from contactmine.functions import dom as D, fields as X
from contactmine.functions.locations import find_location
from contactmine.functions.text import visible_text
from contactmine.functions.urls import page_hrefs
from contactmine.operators import quality as Q
from contactmine.operators.frontier import landed_directory
from contactmine.operators.listings import page_listings
from contactmine.plans.contacts import clean_contacts, directory_cards, extract_contacts
from contactmine.plans.profiles import ADDRESS_LABELS, BIO_LABELS, SOURCE_A, SOURCE_B, SOURCE_C, source_d
from contactmine.sources.dom import nodes_table, parse_pages
from contactmine.sources.pages import region_table, select_directory, select_regions
from contactmine.streaming.contacts import rejected

PROFILE = """<html><body><h1>Ann Lee</h1><p>Gulf Group</p><h2>Gulf Group LLC</h2>
<a href="tel:+18135550101?x=1">call</a><a href="mailto:ann@example.com?subject=hi">mail</a>
<div>Company</div><div>Gulf Holdings</div></body></html>"""


def pages(spark, *htmls):
    rows = [(i, f"https://h.example.com/p/{i}", h) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def read(spark, html, make):
    parsed = parse_pages(pages(spark, html))
    return parsed.select(make(F.col("dom"), F.col("body_text")).alias("v")).first()["v"]


def test_profile_page(spark):
    got = parse_pages(pages(spark, PROFILE)).select(
        X.name_h1_first(F.col("dom"), F.col("body_text")),
        X.mailto_email(F.col("dom")),
        X.tel_phone(F.col("dom"), F.col("body_text")),
        X.company_after_heading(F.col("dom"), F.col("body_text")),
        X.company_h2_or_label(F.col("dom"), F.col("body_text")),
        X.label_sibling_text(F.col("dom"), F.col("body_text"), "COMPANY"),
    ).first()
    assert tuple(got) == ("Ann Lee", "ann@example.com", "+18135550101", "Gulf Group", "Gulf Group LLC", "Gulf Holdings")


@pytest.mark.parametrize(
    "links, expected",
    [
        ('<a href="tel:18886864222">Call us</a><a href="tel:8135550101">(813) 555-0101</a>', "(813) 555-0101"),
        ('<a href="tel:18886864222">Call us</a>', None),
        ('<a href="tel:8135550101">Call</a>', "8135550101"),
        ('<a href="tel:1">(813) 555-0101</a>', "(813) 555-0101"),
        ("", None),
    ],
)
def test_header_phone(spark, links, expected):
    assert read(spark, links, lambda d, b: X.phone_from_links(d, b, ["8886864222"])) == expected


def test_tree_repairs_markup(spark):
    html = "<p>a<b>b<p>c</b><ul><li>x<li>y</ul><div>z<br/>w</div><script>'</p><h1>no</h1>'</script><!-- <h1>no</h1> -->"
    nodes = nodes_table(parse_pages(pages(spark, html))).orderBy("node_id").collect()
    assert [n.tag for n in nodes] == ["p", "b", "p", "ul", "li", "li", "div", "br", "script"]
    assert [n.text for n in nodes if n.tag == "li"] == ["x", "y"]
    assert [n.parent_id for n in nodes if n.tag == "li"] == [3, 3]
    assert [n.text for n in nodes if n.tag == "div"] == ["z\nw"]


def test_axes(spark):
    html = "<div id=a><p>one</p><section><p>two <i>deep</i></p><p>three</p></section></div><p>four</p>"
    pick = lambda word: lambda d, b: D.by_text(d, b, word)
    assert read(spark, html, lambda d, b: pick("DEEP")(d, b)["tag"]) == "i"
    assert read(spark, html, lambda d, b: D.parent(d, pick("deep")(d, b))["tag"]) == "p"
    assert read(spark, html, lambda d, b: D.text_of(b, D.following(d, pick("two")(d, b)))) == "three"
    assert read(spark, html, lambda d, b: D.text_of(b, D.following(d, pick("three")(d, b)))) == "four"
    block = lambda within: lambda d, b: D.nearest_ancestor(d, pick("deep")(d, b), ["div"], within)["tag"]
    assert read(spark, html, block(None)) == "div"
    assert read(spark, html, block(2)) == "p"
    assert read(spark, html, lambda d, b: D.text_of(b, D.previous_sibling(d, pick("three")(d, b)))) == "two deep"


def test_bio_fallbacks(spark):
    bio = lambda d, b: X.labelled_block(d, b, BIO_LABELS)
    assert read(spark, "<div><b>About</b> me</div>", bio) == "About me"
    assert read(spark, "<main><span>x</span><p>prose</p></main>", bio) == "prose"
    assert read(spark, "<div class='a content'><p>text</p></div>", bio) == "text"
    assert read(spark, "<p class='my-bio'>short</p>", bio) == "short"
    assert read(spark, "<p>nothing</p>", bio) is None
    long_about = f"<div>About {'x ' * 1100}</div><main><p>main</p></main>"
    assert read(spark, f"<div><b>About</b> {'x ' * 1100}</div>", bio).startswith("About x x")
    short = lambda d, b: X.labelled_block(d, b, BIO_LABELS, max_chars=2000)
    assert read(spark, long_about, short) == "main"


def test_card_cap(spark):
    html = "<body>" + "".join(f"<article><h3>t{i}</h3></article>" for i in range(130)) + "</body>"
    assert read(spark, html, lambda d, b: F.size(page_listings(d, b))) == 130
    assert read(spark, html, lambda d, b: F.size(page_listings(d, b, cap=100))) == 100


def test_next_page(spark):
    flag = lambda d, b: Q.has_next_page(d, b)
    assert read(spark, "<button>Next</button>", flag)
    assert not read(spark, "<button disabled>Next</button>", flag)
    assert not read(spark, "<button aria-disabled='true'>Next</button>", flag)
    assert read(spark, "<button disabled>Next</button><a href='/2'>Next</a>", flag)
    assert not read(spark, "<p>next</p>", flag)


def test_location_scopes(spark):
    by_label = lambda d, b: X.location_from_labels(d, b, SOURCE_A.location, ADDRESS_LABELS)
    html = "<p>Rome, IT 1</p><dl><dt>Office</dt><dd>7 Tampa, Florida 33601</dd></dl>"
    assert read(spark, html, by_label) == "Tampa, FL"
    pin = lambda d, b: X.location_from_pin(d, b, source_d("h.example.com").location)
    html = "<p>1 Rome, IT 1</p><div><i class=map-pin></i>\n9 MIAMI BEACH, FL 33101</div>"
    assert read(spark, html, pin) == "Miami Beach, FL"


HOSTILE = [
    None,
    "",
    "<p>a<b>b<br>c",
    "<script>var t = '</p>';",
    "<p>12 Tampa,\xa0FL\xa033601</p>",
    "word " * 20_000 + ", FL 33601",
    "word " * 20_000,
    "a, b c, " * 6_000,
    "x" * 100_000,
    "x" * 50_000 + "@" + "y" * 50_000,
    "<!-- never closed " + "y " * 20_000,
    "<div>" * 3_000 + "deep",
    "(813" * 20_000,
    "former " * 10_000,
]


@pytest.mark.parametrize("profile", [SOURCE_A, SOURCE_B, SOURCE_C, source_d("h.example.com")], ids="ABCD")
def test_hostile_pages_finish(spark, profile):
    htmls = [h if h is None else f"<h1>Car Wash</h1><p>About</p>{h}" for h in HOSTILE]
    df = pages(spark, *htmls).withColumn("final_url", F.lit("https://h.example.com/profile/x1"))
    started = time.time()
    got = extract_contacts(df, profile).collect()
    assert time.time() - started < 60
    # Page 0 has no html; every other page mentions the keyword, for C only beside its label.
    if profile.layout != "cards":
        assert len(got) == len(HOSTILE) - 1
    assert all(r.parse_error is None for r in got)


def test_hostile_texts_finish(spark):
    df = pages(spark, *HOSTILE)
    started = time.time()
    for rule in (SOURCE_A.location, SOURCE_B.location, SOURCE_C.location):
        df.select(find_location(F.col("html"), rule)).collect()
    df.select(visible_text(F.col("html")), page_hrefs(F.col("html"))).collect()
    assert time.time() - started < 60


def test_no_break_space_in_address(spark):
    df = pages(spark, "<p>12 Tampa,&nbsp;FL&nbsp;33601</p>")
    shown = df.select(visible_text(F.col("html")).alias("t"))
    assert shown.select(find_location(F.col("t"), SOURCE_B.location)).first()[0] == "Tampa, FL"


def test_bad_page_goes_to_rejects(spark):
    parsed = parse_pages(pages(spark, "<p>fine</p>")).withColumn(
        "parse_error", F.when(F.col("page_id") == 0, F.lit("ValueError: x"))
    )
    assert rejected(parsed).count() == 1


def frontier_pages(spark, rows):
    return spark.createDataFrame(
        rows, "region string, region_ord int, page_num int, url string, html string"
    )


def links(*paths):
    return "".join(f'<a href="{p}">x</a>' for p in paths)


def test_crawl_a_stops_and_sorts(spark):
    p = lambda n: f"/business-broker/x/y/BW{n}"
    directory = frontier_pages(
        spark,
        [
            ("FL", 0, 1, "https://h.example.com/fl/", links(p(3), p(1), "/about")),
            ("FL", 0, 2, "https://h.example.com/fl/page-2/", links(p(1))),
            ("FL", 0, 3, "https://h.example.com/fl/page-3/", links(p(9))),
            ("NY", 1, 1, "https://h.example.com/ny/", links(p(3), p(4))),
        ],
    )
    body = "<h1>Ann {}</h1><p>Group</p><p>car wash</p>"
    found = spark.createDataFrame(
        [(n, f"https://h.example.com{p(n)}", body.format(n)) for n in (1, 3, 4, 9)],
        "page_id long, url string, html string",
    )
    got = clean_contacts(found, directory, SOURCE_A).collect()
    assert sorted((r.region, r.full_name) for r in got) == [("FL", "Ann 1"), ("FL", "Ann 3"), ("NY", "Ann 4")]


def test_crawl_d_skips_top_links_and_redirects(spark):
    host = "h.example.com"
    top = [f"/profile/top-{i}" for i in range(3)]
    directory = frontier_pages(
        spark,
        [("FL", 0, n, f"https://{host}/dir/{n}", links(*top, f"/profile/ann-{n}", "/profile/ab")) for n in (1, 2, 51)],
    )
    html = "<h1>N</h1><article><h3>Gas Station {}</h3></article><p>ann{}@example.com support@h.example.com</p>"
    rows = [(n, f"https://{host}/profile/ann-{n}", html.format(n, n), f"https://{host}/profile/ann-{n}") for n in (1, 51)]
    rows.append((2, f"https://{host}/profile/ann-2", html.format(2, 2), f"https://{host}/login"))
    found = spark.createDataFrame(rows, "page_id long, url string, html string, final_url string")
    got = clean_contacts(found, directory, source_d(host)).collect()
    assert [(r.email, r.notes) for r in got] == [("ann1@example.com", "Active: Gas Station — keywords: gas station")]


def test_directory_pages_are_found_without_shuffling_html(spark):
    regions = region_table(spark, [("A", "FL", "https://h.example.com/fl", 1, 60), ("A", "NY", "https://h.example.com/ny/", 21, 1)])
    landed = spark.createDataFrame(
        [(f"https://h.example.com/{u}", u) for u in ("fl/", "fl/page-2/", "fl/page-61/", "ny/", "ny/page-21/")], "url string, html string"
    )
    got = landed_directory(landed, regions)
    assert sorted((r.region, r.region_ord, r.page_num, r.html) for r in got.collect()) == [
        ("FL", 0, 1, "fl/"), ("FL", 0, 2, "fl/page-2/"), ("NY", 1, 21, "ny/page-21/"),
    ]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange hash" in line and "html" in line for line in plan.splitlines())
    assert [r.region for r in select_regions(regions, ["NY"]).collect()] == ["NY"]
    assert select_regions(regions).count() == 2
    assert [r.start_page for r in select_directory(regions, "NY").collect()] == [21]


def test_crawl_c_takes_names_from_cards(spark):
    card = "<li><h4>Card Name</h4><p>Card Group</p><a href='/x/1'>More details »</a></li>"
    directory = frontier_pages(spark, [("FL", 0, 1, "https://h.example.com/fl/", f"<ul>{card}{card}</ul>")])
    cards = directory_cards(directory, "region").collect()
    assert [(c.pos, c.url, c.card_name, c.card_company) for c in cards] == [
        (i, "https://h.example.com/x/1", "Card Name", "Card Group") for i in (0, 1)
    ]
    html = "<h1>Page Name</h1><div><b>Bio</b> wash concepts</div>"
    found = spark.createDataFrame([(1, "https://h.example.com/x/1", html)], "page_id long, url string, html string")
    got = clean_contacts(found, directory, SOURCE_C).collect()
    assert [(r.full_name, r.company, r.notes) for r in got] == [("Card Name", "Card Group", "Wash Concepts")]


def test_label_after_letters_with_longer_lower_case(spark):
    """The place of a label is not shifted by letters whose lower case is two characters."""
    for text in ("II x", "İİ x", "İ" * 8, "🎉 İ x"):
        html = f"<p>{text}</p><ul><li>COMPANY<li>Acme</ul><div>Beta</div>"
        assert read(spark, html, lambda d, b: X.label_sibling_text(d, b, "Company")) == "Acme"


def test_prefix_word_before_long_white_space(spark):
    gap = "&nbsp;" * 300
    for html, want in (
        (f"<p>Building{gap}North Tower</p>", "North Tower"),
        (f"<div>{gap}<span>{gap}building \t{gap}North{gap[:60]}Tower{gap}</span></div>", "North" + "\xa0" * 10 + "Tower"),
        (f"<p>{gap}Rebuilding{gap}North</p>", None),
        (f"<p>Building{gap}{'x' * 200}</p><p>Company Acme</p>", "Acme"),
        (f"<p>Building{'x' * 300}</p>", None),
    ):
        assert read(spark, f"<html><body>{html}</body></html>", X.prefix_word_text) == want
