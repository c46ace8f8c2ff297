"""The de-duplicated table of a stream's contacts, kept up to date by merging new batches only.

Under ``compact`` a table has ``data``, split by ``version`` and ``bucket`` (of the
de-duplication key), and ``manifest``, one small folder a version. A run takes the
committed batches that no manifest names, finds the buckets that their keys fall in,
merges these with the newest version of the same buckets, and writes them as a new
version. The manifest row of a bucket puts its new version in place of the old one;
buckets without new keys are neither read nor written. A run that fails before its
manifest is written leaves nothing that readers see, and the next run writes the same
version again. Runs of one table follow one another; streams may append meanwhile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from contactmine.operators.contacts import deduplicate, normalise, strip_all, with_dedup_key
from contactmine.streaming.ledger import committed_rows, ledger, read_if_there

BUCKETS = 256
_MANIFEST = "query_id string, batch_id long, bucket int, version long"
_BATCH = ["query_id", "batch_id"]
_FIRST = ["batch_id", "query_id", "page_id"]


def manifest(spark: SparkSession, table: str) -> DataFrame:
    """A row per merged batch (``query_id``, ``batch_id``) or bucket written (``bucket``), with its ``version``."""
    found = read_if_there(spark, f"{table.rstrip('/')}/compact/manifest", _MANIFEST)
    return found if found is not None else spark.createDataFrame([], _MANIFEST)


def compacted(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The first row of each key over all merged batches, as of a version or now.

    The newest folder of each bucket is chosen on the partition columns, so Spark
    prunes the others at run time.
    """
    data = read_if_there(spark, f"{table.rstrip('/')}/compact/data", None)
    if data is None:
        raise ValueError(f"nothing of {table} has been compacted yet")
    written = manifest(spark, table).where(F.col("bucket").isNotNull())
    if version is not None:
        written = written.where(F.col("version") <= version)
    newest = written.groupBy("bucket").agg(F.max("version").alias("version"))
    keys = {"version": F.col("version").cast("long"), "bucket": F.col("bucket").cast("int")}
    return data.withColumns(keys).join(newest, ["version", "bucket"], "left_semi").drop("version")


def compact_new(spark: SparkSession, table: str, buckets: int = BUCKETS) -> int | None:
    """Merge the batches committed since the last run; the new version, or None if there are none.

    First by batch, then by stream and page, whenever a batch arrives: of rows with
    one key the smallest such place stays. ``buckets`` holds for the life of a table.
    """
    root = f"{table.rstrip('/')}/compact"
    known = manifest(spark, table)
    version = (known.agg(F.max("version")).first()[0] or 0) + 1
    # Written down, as streams may commit more batches while this runs.
    taken = f"{root}/taken/version={version}"
    done = known.where(F.col("batch_id").isNotNull())
    ledger(spark, table).select(*_BATCH).join(done, _BATCH, "left_anti").coalesce(1).write.mode("overwrite").parquet(taken)
    batches = spark.read.parquet(taken)
    if batches.isEmpty():
        return None

    fresh = committed_rows(spark, table, "contacts").join(batches, _BATCH, "left_semi")
    first = deduplicate(strip_all(normalise(fresh)).withColumn("ingest_ord", F.struct(*_FIRST))).drop("ingest_ord")
    keyed = with_dedup_key(first).withColumn("bucket", F.pmod(F.xxhash64("dedup_key"), F.lit(buckets)).cast("int"))
    staged = f"{root}/fresh/version={version}"
    keyed.drop("dedup_key").write.mode("overwrite").parquet(staged)
    rows = spark.read.parquet(staged)
    touched = rows.select("bucket").distinct()

    merged = rows
    if not known.where(F.col("bucket").isNotNull()).isEmpty():
        old = compacted(spark, table).join(touched, "bucket", "left_semi")
        merged = rows.unionByName(old, allowMissingColumns=True)
    # At most two rows a key are left, so a bucket fits one task if there are enough buckets.
    merged = deduplicate(merged.withColumn("ingest_ord", F.struct(*_FIRST)).repartition("bucket"), scope=["bucket"])
    merged.drop("ingest_ord").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/data/version={version}")

    entries = batches.unionByName(touched, allowMissingColumns=True)
    entries.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/version={version}")
    return version
