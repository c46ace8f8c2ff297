"""Counts a run reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from contactmine.operators.contacts import with_dedup_key


def matches_per_region(contacts: DataFrame) -> DataFrame:
    return contacts.groupBy("source", "region").agg(F.count("*").alias("matches"))


def totals(contacts: DataFrame) -> DataFrame:
    """Rows and rows after de-duplication per region, per source and overall.

    Distinct keys are first reduced per (group, key), so a hot key costs one
    row per task. NULL marks a subtotal.
    """
    return (
        with_dedup_key(contacts)
        .rollup("source", "region")
        .agg(
            F.count("*").alias("total"),
            F.countDistinct("dedup_key").alias("after_dedup"),
        )
    )


def links_per_directory(
    rows: DataFrame, keys: Sequence[str] = ("region",), approximate: bool = False
) -> DataFrame:
    count = F.approx_count_distinct("url") if approximate else F.countDistinct("url")
    return rows.groupBy(*keys).agg(count.alias("links"))


SKETCH_BITS = 14


def link_sketches(rows: DataFrame, keys: Sequence[str] = ("region",), bits: int = SKETCH_BITS) -> DataFrame:
    """``keys`` and ``sketch``: distinct links as a sketch of at most ``2 ** bits`` bytes, to be stored."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg("url", bits).alias("sketch"))


def merged_links(sketches: DataFrame, keys: Sequence[str] = ("region",)) -> DataFrame:
    """``links`` per prefix of ``keys``, estimated from stored sketches alone; NULL marks a total.

    Sketches of batches that share links count these once. The relative standard
    error is below 1.04 / sqrt(2 ** bits).
    """
    merged = F.hll_union_agg("sketch")
    return sketches.rollup(*keys).agg(F.hll_sketch_estimate(merged).alias("links"))


def drop_counts(pages: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """How many pages each reason drops; a page counts for its first reason only."""
    counts = []
    earlier = F.lit(False)
    for name, condition in reasons.items():
        hit = F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(hit & ~earlier).alias(name))
        earlier = earlier | hit
    counts.append(F.count_if(~earlier).alias("kept"))
    return pages.agg(*counts)


def with_progress(df: DataFrame, name: str = "progress") -> tuple[DataFrame, Observation]:
    """Count rows while another action runs, at no extra pass."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
