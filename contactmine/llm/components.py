"""Connected components of a table of links, by star contraction.

Alternates two steps until nothing changes: every node links its larger
neighbours to its smallest neighbour, then its smaller neighbours to the
smallest. Trees flatten in a logarithmic number of rounds; minima are partial
aggregates, so a node with very many links is no bottleneck.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from contactmine.llm.scratch import materialised


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """``links``: (u, v) with u > v, or both ways round for the large star."""
    smallest = links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    linked = links.join(smallest, "u")
    if larger:
        return linked.where("v > u").selectExpr("v AS u", "m AS v").where("u <> v").distinct()
    kept = linked.selectExpr("v AS u", "m AS v").union(smallest.selectExpr("u", "m AS v"))
    return kept.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node of ``links`` (a, b longs)."""
    links = links.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").where("u <> v").distinct()
    links = materialised(links)
    mark = F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    before = links.agg(*mark).first()
    while before[0]:
        both = links.union(links.selectExpr("v AS u", "u AS v"))
        links = materialised(_star(both, True), 2 * before[0])
        links = materialised(_star(links, False), 3 * before[0])
        now = links.agg(*mark).first()
        if now == before:
            break
        before = now
    roots = links.selectExpr("v AS node", "v AS component").distinct()
    return links.selectExpr("u AS node", "v AS component").union(roots)
