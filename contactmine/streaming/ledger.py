"""Which batches of which streams belong to a table.

A table is three folders: ``contacts``, ``rejects`` and ``ledger``, each split by
``query_id`` and ``batch_id``. Data folders are written first; the ledger's own
folder of the batch, one row, makes them part of the table. It names the stream by
the id that Spark keeps in the stream's checkpoint, so two streams never share a
folder, and a stream that is resumed finds its own.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.utils import AnalysisException

_KEYS = "query_id string, batch_id long"
_LEDGER = f"seen long, contacts long, rejects long, {_KEYS}"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps over restarts, as its checkpoint has it."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()  # one short line
    return json.loads("".join(line["value"] for line in lines))["id"]


def read_if_there(spark: SparkSession, path: str, schema: str | None) -> DataFrame | None:
    """A table that may not have come into being yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """``query_id``, ``batch_id`` and row counts of every committed batch."""
    found = read_if_there(spark, f"{table.rstrip('/')}/ledger", _LEDGER)
    return found if found is not None else spark.createDataFrame([], _LEDGER)


def progress(spark: SparkSession, table: str, every: int = 20) -> DataFrame:
    """Per committed batch: ``pages``, ``contacts``, ``rejects``, ``dropped``, ``pages_so_far``, ``report``.

    ``dropped`` pages could be read and match nothing. ``pages_so_far`` counts the
    stream's batches in order; ``report`` is true where it passes a multiple of ``every``.
    """
    so_far = F.sum("seen").over(Window.partitionBy("query_id").orderBy("batch_id"))
    rows = ledger(spark, table).withColumn("pages_so_far", so_far)
    return rows.select(
        "query_id",
        "batch_id",
        F.col("seen").alias("pages"),
        "contacts",
        "rejects",
        (F.col("seen") - F.col("contacts") - F.col("rejects")).alias("dropped"),
        "pages_so_far",
        (F.expr(f"pages_so_far div {every}") > F.expr(f"(pages_so_far - seen) div {every}")).alias("report"),
    )


def is_committed(spark: SparkSession, table: str, query_id: str, batch_id: int) -> bool:
    """Looks at one folder of the ledger, however many there are."""
    path = f"{table.rstrip('/')}/ledger/query_id={query_id}/batch_id={batch_id}"
    found = read_if_there(spark, path, "seen long")
    return found is not None and not found.isEmpty()


def commit(counts: DataFrame, table: str, query_id: str, batch_id: int) -> None:
    """Write the one row ``counts``: from here on the batch is part of the table."""
    path = f"{table.rstrip('/')}/ledger/query_id={query_id}/batch_id={batch_id}"
    counts.coalesce(1).write.mode("overwrite").parquet(path)


def committed_rows(spark: SparkSession, table: str, part: str) -> DataFrame:
    """Rows of ``part`` in committed batches; folders of other batches are not read.

    The ledger meets the data on its partition columns, so Spark prunes folders
    by it at run time.
    """
    root = table.rstrip("/")
    data = read_if_there(spark, f"{root}/{part}", None)
    if data is None:
        raise ValueError(f"nothing has been written to {root} yet")
    data = data.withColumns(
        {"query_id": F.col("query_id").cast("string"), "batch_id": F.col("batch_id").cast("long")}
    )
    return data.join(ledger(spark, root).select("query_id", "batch_id"), ["query_id", "batch_id"], "left_semi")
