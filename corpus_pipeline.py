"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns what its stage kept, with the columns of documents, the last one packed
pieces. ``run`` applies them in order, writing each result to the shared folder.
Null texts, repeated rows and extra columns pass as the operators say; a stage
on an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from contactmine.llm.line_dedup import RESULTS, drop_common_lines
from contactmine.llm.mixing import mix_sources
from contactmine.llm.ngram_join import similar_groups
from contactmine.llm.packing import pack
from contactmine.llm.quality import fit_quality, quality_verdicts
from contactmine.llm.scratch import documents, materialised, unused


def _keyed(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with a column ``key``, 128 bits of all columns: rows that share it are alike in every column."""
    values = []
    for field in docs.schema.fields:
        plain = "map<" not in field.dataType.simpleString()
        values.append(F.col(field.name) if plain else F.to_json(F.struct(field.name)))
        values.append(F.col(field.name).isNull())
    halves = [F.hex(F.xxhash64(F.lit(seed), *values)) for seed in (1, 2)]
    return docs.withColumn(key, F.concat_ws("-", *halves))


def _decided(keyed: DataFrame, key: str, verdicts: DataFrame) -> DataFrame:
    """Rows of ``keyed`` as many times as ``verdicts`` say: ``_key``, ``_rows`` that share it, ``_times`` in all.

    Which of the rows that share a key stay makes no difference, as they are alike.
    Texts of keys that only one row has are not shuffled for it.
    """
    columns = [c for c in keyed.columns if c != key]
    (times,) = unused(keyed, "_times")
    verdicts = materialised(verdicts.where("_times > 0"))
    one, more = (
        keyed.join(verdicts.where(w).select(F.col("_key").alias(key), F.col("_times").alias(times)), key)
        for w in ("_rows = 1", "_rows > 1")
    )
    each = one.unionByName(more.dropDuplicates([key]))
    return each.select(*columns, F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))).alias(times)).drop(times)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go. Rows of one id go or stay by their own text."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_verdicts(docs, fit_quality(docs, labels), keep_columns=True)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; texts and lengths follow."""
    columns = docs.columns
    kept, _, n_dropped, _ = results = unused(docs, *RESULTS)
    cut = drop_common_lines(docs, results=results)
    changed = F.col(n_dropped) > 0
    cut = cut.withColumns(
        {
            "text": F.when(changed, F.col(kept)).otherwise(F.col("text")),
            "n_chars": F.when(changed, F.char_length(kept).cast("long")).otherwise(F.col("n_chars")),
        }
    )
    return cut.select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, one with the smallest id.

    A null id is never the smallest unless all are null; of several rows with the
    smallest id the one with the smallest key stays. Rows without words are in no
    group, and all stay.
    """
    (key,) = unused(docs, "_key")
    keyed = _keyed(docs, key)
    groups = similar_groups(keyed, key).groupBy("doc_id").agg(
        F.first("component_id").alias("_group"), F.max("n_shingles").alias("_n"), F.count(F.lit(1)).alias("_rows")
    )
    ids = keyed.groupBy(F.col(key).alias("_key")).agg(F.first("doc_id").alias("_id"))
    named = groups.withColumnRenamed("doc_id", "_key").join(ids, "_key")
    named = materialised(named)
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_key")
    first = named.where("_n > 0").groupBy("_group").agg(F.min_by(F.struct("_key", "_rows"), order).alias("r"))
    stay = first.select("r._key", "r._rows", F.lit(1).cast("long").alias("_times"))
    wordless = named.where("_n = 0").select("_key", "_rows", F.col("_rows").alias("_times"))
    return _decided(keyed, key, stay.union(wordless))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows come as many times as the mix takes them, some not at all."""
    (key,) = unused(docs, "_key")
    keyed = _keyed(docs, key)
    copies = mix_sources(keyed, key).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("copies").alias("_times")
    )
    return _decided(keyed, key, copies.withColumnRenamed("doc_id", "_key"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_join", near_duplicates),
    ("source_mix", source_mix),
    ("packing", packing),
]

# No SQL: the stages fit trees, sample and tokenize.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir))
    return docs
