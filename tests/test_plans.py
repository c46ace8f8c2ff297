"""The plans themselves: what is shuffled, what is read, what skew does."""

from __future__ import annotations

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from contactmine.functions.urls import url_host
from contactmine.operators import contacts as C, frontier as U, listings as L, reports as R
from contactmine.operators.matching import with_hits
from contactmine.operators.prefix import running_sum
from contactmine.plans.contacts import build_frontier, collect_contacts, extract_contacts
from contactmine.plans.profiles import SOURCE_A, SOURCE_B, SOURCE_C, source_d
from contactmine.sources.pages import read_pages


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange (?:hash|range|round|Single)", plan(df)))


@pytest.fixture(scope="module")
def pages(spark, sf_dir):
    return read_pages(spark, f"{sf_dir}/pages.parquet")


@pytest.mark.parametrize("profile", [SOURCE_A, SOURCE_B, SOURCE_C, source_d("h.example.com")], ids="ABCD")
def test_profile_branch_is_narrow(pages, profile):
    df = extract_contacts(pages, profile)
    text = plan(df)
    assert exchanges(df) == 0
    assert text.count("MapInArrow") == 1
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_keyword_test_runs_once_before_parsing(pages):
    text = plan(extract_contacts(pages, SOURCE_B))
    below_python = text.split("MapInArrow")[1]
    assert "Filter (size(hits" in below_python
    # In the plan once, not copied into the filter.
    assert below_python.count("Contains(lower(") <= 2 * len(SOURCE_B.keywords)


def test_html_is_read_only_where_needed(pages):
    directory = pages.select(
        F.lit("r").alias("region"), F.lit(0).alias("region_ord"), F.col("page_id").alias("page_num"), "url", "html"
    )
    rows = U.frontier_rows(U.page_links(directory), "region", "page_num")
    assert "html" not in str(rows.columns)
    novel = U.novelty(U.first_seen(rows, ["region"]), directory, ["region", "page_num"])
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan(novel))
    assert sorted(scans) == ["page_id:bigint", "page_id:bigint,url:string,html:string"]
    cut = with_hits(pages.select("page_id", "url"), "url", ["com"])
    assert "html" not in plan(cut)


def test_html_is_not_shuffled(pages):
    directory = pages.select(
        F.lit("r").alias("region"), F.lit(0).alias("region_ord"), F.col("page_id").alias("page_num"), "url", "html"
    )
    df = collect_contacts(pages, directory, replace(SOURCE_A, url_pattern="."))
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    for line in plan(df).splitlines():
        if "Exchange" in line:
            assert "html" not in line
    assert "Join" in optimized


def test_first_row_is_taken_before_the_shuffle(spark):
    rows = spark.range(1000).select(
        F.col("id").alias("ingest_ord"),
        *[F.concat(F.lit("x"), F.col("id") % 7).alias(c) for c in ("full_name", "phone_number", "location", "company", "email", "source_url", "notes")],
    )
    text = plan(C.deduplicate(rows))
    assert "WindowGroupLimit" in text and "Partial" in text
    frontier = rows.select(F.col("email").alias("region"), F.col("ingest_ord").alias("page_num"), F.lit(0).alias("pos"), F.col("notes").alias("url"))
    assert "partial_min" in plan(U.first_seen(frontier, ["region"]))
    assert "Partial" in plan(U.cap_per_group(frontier, ["region"], 10))
    cards = frontier.select(
        (F.col("page_num") % 9).alias("page_id"), F.col("page_num").cast("int").alias("pos"), *[F.col("url").alias(c) for c in ("title", "description", "type", "parent_text")]
    )
    assert "Partial" in plan(L.listing_rows(cards, cap=100))
    assert "Exchange" not in plan(L.listing_rows(cards))


def test_running_sum_keeps_one_group_apart(spark):
    """One region holds everything: only the top level's few rows meet per region."""
    df = spark.range(20_000).select(F.when(F.col("id") % 20_001 < 20_000, "hot").alias("region"), F.col("id").alias("page_num"), F.lit(1).alias("added"))
    got = running_sum(df, ["region"], "page_num", F.col("added"))
    text = plan(got)
    keys = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", text)
    assert len(keys) == 2 and sum("," not in k for k in keys) == 1
    row = got.agg(F.max("total").alias("m"), F.sum("total").alias("s"), F.count("*").alias("n")).first()
    assert (row.m, row.n, row.s) == (20_000, 20_000, 20_000 * 20_001 // 2)


def test_skewed_frontier_is_whole(spark):
    """A third of all links point at one URL, a third of all pages are in one region."""
    links = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 11)).alias("region"),
        (F.col("id") / 10).cast("long").alias("page_num"),
        (F.col("id") % 10).cast("int").alias("pos"),
        F.when(F.col("id") % 3 == 1, F.lit("u")).otherwise(F.concat(F.lit("u"), F.col("id") % 5000)).alias("url"),
    )
    expected = {}
    for r in links.collect():
        key, at = (r.region, r.url), (r.page_num, r.pos)
        expected[key] = min(expected.get(key, at), at)
    got = {(r.region, r.url): (r.page_num, r.pos) for r in U.first_seen(links, ["region"]).collect()}
    assert got == expected
    assert R.links_per_directory(links).agg(F.sum("links")).first()[0] == len(expected)


def test_layout_does_not_change_results(spark, pages):
    profile = replace(SOURCE_B, keywords=["free", "licen", "ation"])
    columns = ["page_id", "full_name", "phone_number", "location", "email", "notes"]
    one, many = (
        sorted(map(tuple, extract_contacts(pages.repartition(n), profile).select(columns).collect())) for n in (1, 17)
    )
    assert one == many and one


def test_rollup_total_is_the_sum_of_its_parts(spark):
    rows = spark.range(100).select(
        F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.concat(F.lit("r"), F.col("id") % 7).alias("region"),
        F.concat(F.lit("n"), F.col("id") % 50).alias("full_name"), F.lit("N/A").alias("phone_number"), F.lit("N/A").alias("company"),
    )
    got = R.totals(rows).collect()
    leaf = sum(r.total for r in got if r.region is not None)
    (grand,) = [r for r in got if r.source is None]
    assert grand.total == leaf == 100 and grand.after_dedup == 50
    assert R.matches_per_region(rows).agg(F.sum("matches")).first()[0] == 100


def test_frontier_of_each_layout_plans_without_cross_joins(pages):
    directory = pages.select(
        url_host(F.col("url")).alias("region"), F.lit(0).alias("region_ord"), F.col("page_id").alias("page_num"), "url", "html"
    )
    for profile in (SOURCE_A, SOURCE_B, SOURCE_C, source_d("h.example.com")):
        text = plan(build_frontier(directory, profile))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
