"""URLs seen over many runs, kept on disk behind a Bloom filter.

Under a folder there are ``urls``, split by ``bucket`` (of the URL's hash), and
``filter``, bitmaps of 32,768 bits. A URL belongs to one bitmap, where it sets
``_BITS`` bits. New rows are tested against the bitmaps first; only those that may
have been seen are looked up in the URLs, so the large table is not shuffled: it is
scanned past a few rows, in their buckets. With more URLs than the filter was made
for, more rows are looked up, with the same result.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from contactmine.operators.frontier import broadcast_if_small
from contactmine.session import shared_dir
from contactmine.streaming.ledger import read_if_there

_BITS = 5
_BITMAP = 32_768  # the size that Spark's bitmap functions build
_BITS_A_URL = 10
_SHAPE = "bitmaps long, buckets int"
_URLS = "url string, batch string, bucket int"
_FILTER = "bitmap long, bits binary, batch string"


def make_store(spark: SparkSession, folder: str, expected: int, buckets: int = 64) -> None:
    """An empty store for about ``expected`` URLs: with so many, a few in a hundred new ones are looked up."""
    bitmaps = max(1, -(-expected * _BITS_A_URL // _BITMAP))
    spark.createDataFrame([(bitmaps, buckets)], _SHAPE).coalesce(1).write.parquet(f"{folder}/shape")


def _bitmap_of(url: Column, bitmaps: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(bitmaps))


def _bits(url: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(url, F.lit(k)), F.lit(_BITMAP)).cast("int") for k in range(_BITS)]


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), place % 8) == 1


def _read(spark: SparkSession, folder: str, part: str, schema: str) -> DataFrame:
    found = read_if_there(spark, f"{folder}/{part}", schema)
    return found if found is not None else spark.createDataFrame([], schema)


def remember(rows: DataFrame, folder: str) -> None:
    """Add the URLs of ``rows``; adding URLs again changes no result. NULL is no URL."""
    spark, batch = rows.sparkSession, f"batch={uuid.uuid4().hex}"
    shape = spark.read.schema(_SHAPE).parquet(f"{folder}/shape").first()
    bucket = F.pmod(F.xxhash64("url", F.lit("bucket")), F.lit(shape.buckets)).cast("int")
    urls = rows.select("url").where(F.col("url").isNotNull()).distinct().withColumn("bucket", bucket)
    urls.repartition("bucket").write.partitionBy("bucket").parquet(f"{folder}/urls/{batch}")
    added = _read(spark, folder, "urls", _URLS).where(F.col("batch") == batch.removeprefix("batch="))
    places = added.select(_bitmap_of(F.col("url"), shape.bitmaps).alias("bitmap"), F.explode(F.array(*_bits(F.col("url")))).alias("place"))
    bits = places.groupBy("bitmap").agg(F.bitmap_construct_agg("place").alias("bits"))
    bits.write.parquet(f"{folder}/filter/{batch}")


def maybe_remembered(rows: DataFrame, folder: str) -> DataFrame:
    """``rows`` with ``_maybe``: false only for URLs that the store does not hold."""
    spark, url = rows.sparkSession, F.col("url")
    shape = spark.read.schema(_SHAPE).parquet(f"{folder}/shape").first()
    bits = _read(spark, folder, "filter", _FILTER).groupBy("bitmap").agg(F.bitmap_or_agg("bits").alias("_bits"))
    tested = rows.withColumn("_bitmap", _bitmap_of(url, shape.bitmaps)).join(
        bits.withColumnRenamed("bitmap", "_bitmap"), "_bitmap", "left"
    )
    hit = reduce(Column.__and__, [_is_set(F.col("_bits"), place) for place in _bits(url)])
    bucket = F.pmod(F.xxhash64(url, F.lit("bucket")), F.lit(shape.buckets)).cast("int")
    found = {"_maybe": F.coalesce(hit, F.lit(False)) & url.isNotNull(), "_bucket": bucket}
    return tested.withColumns(found).drop("_bitmap", "_bits")


def skip_remembered(rows: DataFrame, folder: str) -> DataFrame:
    """Rows whose URL the store does not hold; as ``frontier.skip_seen`` over all remembered URLs."""
    spark = rows.sparkSession
    scratch = f"{shared_dir(spark)}/seen-{uuid.uuid4().hex}"
    maybe_remembered(rows, folder).write.parquet(scratch)
    tested = spark.read.parquet(scratch)
    asked = tested.where("_maybe").select("url", F.col("_bucket").alias("bucket")).distinct()
    urls = _read(spark, folder, "urls", _URLS).select("url", "bucket")
    known = urls.join(broadcast_if_small(asked), ["url", "bucket"], "left_semi").select("url").distinct()
    new = tested.where("_maybe").join(known, "url", "left_anti").select(*rows.columns)
    return tested.where("NOT _maybe").select(*rows.columns).unionByName(new)
