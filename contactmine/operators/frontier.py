"""The crawl frontier: links, first sightings, novelty, stop rule, caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from contactmine.functions.urls import (
    directory_page_url,
    holds_none_of,
    is_profile_url,
    page_hrefs,
    resolve_url,
    skip_first,
)
from contactmine.operators.prefix import null_safe_join, running_sum

# A group is ranked in this many parts before its survivors meet.
_RANK_PARTS = 64


def page_links(pages: DataFrame, any_element: bool = False) -> DataFrame:
    """Replace ``html`` by ``links``: absolute URLs in page order, repeats kept."""
    hrefs = page_hrefs(F.col("html"), any_element)
    if any_element:
        hrefs = F.concat(page_hrefs(F.col("html")), hrefs)
    return (
        pages.withColumn("_hrefs", hrefs)
        .withColumn(
            "links", F.transform("_hrefs", lambda h: resolve_url(F.col("url"), h))
        )
        .drop("html", "_hrefs")
    )


def links_table(pages: DataFrame) -> DataFrame:
    """``page_id, url, pos, href``: every link as it stands on the page."""
    return pages.select(
        "page_id", "url", F.posexplode(page_hrefs(F.col("html"))).alias("pos", "href")
    )


def profile_links(
    linked: DataFrame,
    pattern: str,
    min_slug: int = 0,
    excluded: Sequence[str] = (),
    skip: int = 0,
) -> DataFrame:
    """Keep a page's distinct profile links in order, less the first ``skip``; all inside the row."""

    def wanted(url: Column) -> Column:
        return is_profile_url(url, pattern, min_slug) & holds_none_of(url, excluded)

    unique = F.array_distinct(F.filter("links", wanted))
    return linked.withColumn("links", skip_first(unique, skip) if skip else unique)


def frontier_rows(linked: DataFrame, *keys: str) -> DataFrame:
    """One narrow row per link: the keys, ``pos`` and ``url``."""
    return linked.select(*keys, F.posexplode("links").alias("pos", "url"))


def distinct_urls(rows: DataFrame) -> DataFrame:
    return rows.select("url").distinct()


def first_seen(
    rows: DataFrame, scope: Sequence[str] = (), order: Sequence[str] = ("page_num", "pos")
) -> DataFrame:
    """The first sighting of each URL per scope.

    A minimum, so each task sends at most one row per URL however often a hot
    URL occurs.
    """
    first = F.min(F.struct(*order)).alias("_first")
    return (
        rows.groupBy(*scope, "url")
        .agg(first)
        .select(*scope, "url", *[F.col("_first")[c].alias(c) for c in order])
    )


def novelty(seen: DataFrame, pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New URLs per page, zero for pages that add nothing. ``keys`` end with the page number."""
    added = seen.groupBy(*keys).agg(F.count("*").alias("added"))
    every = pages.select(*keys).distinct()
    return null_safe_join(every, added, keys, "left").withColumn(
        "added", F.coalesce("added", F.lit(0))
    )


def running_total(new_per_page: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct URLs so far, page by page."""
    *group, page_num = keys
    return running_sum(new_per_page, group, page_num, F.col("added"), "total")


def stop_pages(new_per_page: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First page of each group that adds nothing; NULL when every page adds some."""
    *group, page_num = keys
    return new_per_page.groupBy(*group).agg(
        F.min(F.when(F.col("added") == 0, F.col(page_num))).alias("stop_page")
    )


def until_stop(rows: DataFrame, stops: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the pages before their group's stop page.

    ``stops`` has a row per group: Spark broadcasts it when it is small and
    splits a hot group when it is not.
    """
    *group, page_num = keys
    return null_safe_join(rows, stops, group).filter(
        F.col("stop_page").isNull() | (F.col(page_num) < F.col("stop_page"))
    ).drop("stop_page")


def page_range(
    rows: DataFrame, start_page: int, max_pages: int | None, column: str = "page_num"
) -> DataFrame:
    if max_pages is None:
        return rows.filter(F.col(column) >= start_page)
    return rows.filter(F.col(column).between(start_page, start_page + max_pages - 1))


def directory_pages(regions: DataFrame) -> DataFrame:
    """The numbered page URLs of each directory."""
    last = F.col("start_page") + F.col("max_pages") - 1
    numbered = regions.select(
        "source",
        "region",
        F.col("url").alias("_base"),
        F.explode(F.sequence("start_page", last)).alias("page_num"),
    )
    return numbered.select(
        "source",
        "region",
        "page_num",
        directory_page_url(F.col("_base"), F.col("page_num")).alias("url"),
    )


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Ask for a broadcast only after counting; larger frames take the ordinary join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def landed_directory(pages: DataFrame, regions: DataFrame) -> DataFrame:
    """The landed pages of the directories: ``region, region_ord, page_num, url, html``.

    The page URLs are few rows, so the pages are not shuffled to find them.
    """
    order = regions.select("source", "region", "region_ord")
    numbered = directory_pages(regions).join(order, ["source", "region"])
    return pages.join(broadcast_if_small(numbered), "url").select(
        "region", "region_ord", "page_num", "url", "html"
    )


def cap_per_group(
    rows: DataFrame, group: Sequence[str], n: int | None, order: Sequence[str] = ("page_num", "pos")
) -> DataFrame:
    """The first ``n`` rows of each group, NULL groups too; all when there is no cap.

    A group is ranked in parts first and then over the parts' first ``n`` rows,
    so that no task sorts a whole hot group.
    """
    if n is None:
        return rows
    split = rows.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(_RANK_PARTS)))
    for keys in ([*group, "_part"], group):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        split = split.withColumn("_rn", rank).filter(F.col("_rn") <= n).drop("_rn")
    return split.drop("_part")


def skip_seen(rows: DataFrame, seen: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Rows whose URL was not seen before, in the whole run or within a scope."""
    keys = [*scope, "url"]
    return rows.join(seen.select(*keys).distinct(), keys, "left_anti")


def visit_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy("url")
