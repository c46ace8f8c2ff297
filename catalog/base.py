"""Registry of queries and of the views they share with their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.views import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
# Tables whose rows hold long texts or are turned into pages.
HEAVY = {"pages", "documents", "customer", "part"}
_NAME = re.compile(r"\{(" + "|".join([*TABLES, *VIEWS]) + r")\}")

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input of fewer partitions; large inputs are left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in HEAVY else df


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared view, built by Spark from the given tables."""
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    needed = sorted(set(_NAME.findall(VIEWS[name])))
    return spark.sql(
        VIEWS[name], **{n: view(spark, sf_dir, n) for n in needed}
    )


def _with_views(sql: str) -> str:
    """Put the views a statement names in front of it."""
    chain: list[str] = []

    def need(text: str) -> None:
        for name in _NAME.findall(text):
            if name in VIEWS and name not in chain:
                need(VIEWS[name])
                chain.append(name)

    need(sql)

    def plain(text: str) -> str:
        return _NAME.sub(r"\1", text)

    head = ", ".join(f"{name} AS ({plain(VIEWS[name])})" for name in chain)
    body = plain(sql)
    if not head:
        return body
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {head}, {body.lstrip()[5:]}"
    return f"WITH {head} {body}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``{name}`` in its SQL stands for a table or shared view."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = _with_views(sql)
        return run

    return register
