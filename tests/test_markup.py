"""Ordinary and hostile markup, NULL groups: results worked out by hand."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from contactmine.functions import fields as X
from contactmine.functions.text import visible_text
from contactmine.functions.urls import page_hrefs
from contactmine.operators import frontier as U
from contactmine.sources.dom import parse_pages

HREFS = [
    ('<a data-href="/track" href="/real">x</a>', ["/real"]),
    ("""<a href="/o'neil-1">x</a>""", ["/o'neil-1"]),
    ("<a href=/unquoted>x</a>", ["/unquoted"]),
    ('<a title="a > b" href="/gt">x</a>', ["/gt"]),
    ('<a href=" /lead ">x</a>', ["/lead"]),
    ("<A class=b HREF = '/up' id=c>x</A><a>none</a><a href=''>x</a>", ["/up"]),
    ("<link href=/css><a href='/one?a=1&amp;b=2'>x</a>", ["/one?a=1&b=2"]),
    ("<abbr href=/no>x</abbr>", []),
    ("<a disabled href=/yes>x</a>", ["/yes"]),
]


@pytest.mark.parametrize("html, expected", HREFS)
def test_href_forms(one, html, expected):
    assert one(lambda: page_hrefs(F.col("t")), t=html) == expected


def test_any_element_hrefs(one):
    html = "<button type=button href='/b'>x</button><a data-href=/no>y</a>"
    assert one(lambda: page_hrefs(F.col("t"), any_element=True), t=html) == ["/b"]


def test_open_head(spark, one):
    html = "<html><head><title>t</title><style>s</style><body><h1>Ann</h1><p>car wash</p></body></html>"
    assert one(lambda: visible_text(F.col("t")), t=html) == "Ann\ncar wash"
    pages = spark.createDataFrame([(1, "u", html)], "page_id int, url string, html string")
    row = parse_pages(pages).select(
        "body_text", X.heading_text(F.col("dom"), F.col("body_text")).alias("h")
    ).first()
    assert (row["body_text"], row["h"]) == ("Ann\ncar wash", "Ann")


def test_bracket_in_attribute(one):
    assert one(lambda: visible_text(F.col("t")), t='<p title="a>b">x</p>') == "x"
    assert one(lambda: visible_text(F.col("t")), t="<p title=it's>x</p> it's") == "x\nit's"


@pytest.mark.parametrize("unit", ["<a", "<a ", "<script ", "<div x=", '<a href="'])
def test_unclosed_tags_take_linear_time(one, unit):
    html = unit * (1_000_000 // len(unit))
    started = time.perf_counter()
    one(lambda: F.length(visible_text(F.col("t"))), t=html)
    one(lambda: F.size(page_hrefs(F.col("t"), any_element=True)), t=html)
    assert time.perf_counter() - started < 20


def test_null_groups(spark):
    rows = spark.createDataFrame(
        [(None, 1, 1, "a"), (None, 2, 1, "b"), ("r", 1, 1, "c"), ("r", 2, 1, "d"), ("r", 3, 1, "d")],
        "region string, page_num int, pos int, url string",
    )
    pages = rows.select("region", "page_num")
    seen = U.first_seen(rows, ["region"])
    keys = ["region", "page_num"]
    added = U.novelty(seen, pages, keys)
    assert {tuple(r) for r in added.select(*keys, "added").collect()} == {
        (None, 1, 1), (None, 2, 1), ("r", 1, 1), ("r", 2, 1), ("r", 3, 0),
    }
    totals = U.running_total(added, keys)
    assert {tuple(r) for r in totals.select(*keys, "total").collect()} == {
        (None, 1, 1), (None, 2, 2), ("r", 1, 1), ("r", 2, 2), ("r", 3, 2),
    }
    kept = U.until_stop(rows, U.stop_pages(added, keys), keys)
    assert sorted(r["url"] for r in kept.collect()) == ["a", "b", "c", "d"]


@pytest.mark.parametrize("n", [1, 2, 1000, 1001])
def test_cap_takes_null_groups_and_text_keys(spark, n):
    rows = spark.createDataFrame(
        [(None, "p1", 1), (None, "p1", 2), (None, "p2", 1), ("r", "p1", 1)],
        "region string, page_num string, pos int",
    )
    kept = U.cap_per_group(rows, ["region"], n).collect()
    assert len(kept) == min(n, 3) + 1
    assert (None, "p1", 1) in {tuple(r) for r in kept}


def test_running_total_over_blocks(spark):
    rows = spark.range(0, 6_000_000, 700_000).select(F.lit("g").alias("g"), F.col("id").alias("at"), F.lit(1).alias("added"))
    got = U.running_total(rows, ["g", "at"]).orderBy("at").collect()
    assert [r["total"] for r in got] == list(range(1, 10))
