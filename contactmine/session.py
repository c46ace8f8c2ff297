"""Session settings that the plans in this package rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed join
    # partitions, turn a sort-merge join into a broadcast one by measured size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Pages are wide rows: small Arrow batches keep Python workers' memory flat.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.session.timeZone": "UTC",
    # Do not record a Python call site for each column expression: wide plans
    # are then built in a fraction of the time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # The seen-URL state of a stream lives off-heap and on disk.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    master: str | None = None, app_name: str = "contactmine", **overrides: str
) -> SparkSession:
    """A session with the settings above; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, ``spark.checkpoint.dir``.

    Only where the session names none (local tests) is a folder made and set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="contactmine-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made
