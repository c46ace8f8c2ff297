"""Page tables and the small tables that say which directories to read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from contactmine.schema import PAGE_SCHEMA


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A landed crawl: ``page_id, url, html`` and perhaps ``final_url``."""
    return with_final_url(spark.read.parquet(path))


def with_final_url(pages: DataFrame) -> DataFrame:
    """Where a crawl kept no final URL, it is the requested one."""
    if "final_url" in pages.columns:
        return pages
    return pages.withColumn("final_url", F.col("url"))


def stream_pages(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    landed_at: str | None = None,
) -> DataFrame:
    """Pages as they arrive in a folder; ``landed_at`` names a timestamp they carry."""
    schema = PAGE_SCHEMA
    if landed_at is not None:
        schema = T.StructType([*PAGE_SCHEMA.fields, T.StructField(landed_at, T.TimestampType())])
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_final_url(reader.parquet(path))


def region_table(
    spark: SparkSession, rows: Sequence[tuple[str, str, str, int, int]]
) -> DataFrame:
    """``source, region, region_ord, url, start_page, max_pages``: one row per directory."""
    numbered = [
        (source, region, i, url, start, pages)
        for i, (source, region, url, start, pages) in enumerate(rows)
    ]
    return spark.createDataFrame(
        numbered,
        "source string, region string, region_ord int, url string, "
        "start_page int, max_pages int",
    )


def select_regions(regions: DataFrame, wanted: Sequence[str] = ()) -> DataFrame:
    """The wanted regions; none named, or all of them, gives all."""
    return regions.filter(F.col("region").isin(list(wanted))) if wanted else regions


def select_directory(regions: DataFrame, alternative: str | None = None) -> DataFrame:
    """A source's first directory, or the named alternative with its own page range."""
    if alternative is not None:
        return regions.filter(F.col("region") == alternative)
    return regions.filter(F.col("region_ord") == 0)


def single_page(pages: DataFrame, url: str) -> DataFrame:
    """One page by URL; the test reaches the parquet scan."""
    return pages.filter(F.col("url") == F.lit(url))
