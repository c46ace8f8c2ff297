"""Intermediate tables in the shared folder, and other small helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from contactmine.session import shared_dir


ROWS_A_FILE = 50_000


def materialised(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back.

    The table cuts the lineage: an executor lost later costs no recomputation,
    and random or partition-dependent columns are fixed from here on. ``rows``,
    about how many narrow rows there are at most, saves writing small tables as
    very many files: their number then grows with the rows.
    """
    if rows is not None:
        df = df.coalesce(rows // ROWS_A_FILE + 1)
    path = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """These names, with as many ``_`` added as keep them apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    tail = ""
    while any((name + tail).lower() in taken for name in names):
        tail += "_"
    return [name + tail for name in names]


def shards_for(df: DataFrame, per_partition: int = 8, least: int = 16) -> int:
    """A number of shards in proportion to the input's partitions."""
    return max(least, per_partition * df.rdd.getNumPartitions())


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
