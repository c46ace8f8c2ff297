"""The operators as registered queries over the given tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from contactmine.llm.alignment import align_tokenizers
from contactmine.llm.discriminant import document_statistics, fit_discriminant, score_quality
from contactmine.llm.exact_dedup import exact_groups
from contactmine.llm.language import identify_language, train, training_sample
from contactmine.llm.line_dedup import drop_common_lines
from contactmine.llm.mixing import mix_sources
from contactmine.llm.ngram_join import similar_groups
from contactmine.llm.packing import pack
from contactmine.llm.quality import fit_quality, quality_verdicts
from contactmine.llm.sanitise import private_spans, span_columns
from contactmine.llm.scratch import documents, materialised
from contactmine.llm.substring_dedup import drop_repeated_windows
from contactmine.llm.token_counts import token_counts
from contactmine.llm.variants import spelling_variants

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@_query(
    "op4_exact_dedup",
    r"""
    WITH d AS (
      SELECT doc_id, length(coalesce(text, '')) AS chars,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS plain
      FROM documents),
    best AS (
      SELECT plain, arg_min(doc_id, (-chars, doc_id)) AS keep_id, count(*) AS group_size
      FROM d GROUP BY plain)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept,
           sha256(plain) AS text_sha256
    FROM d JOIN best USING (plain)""",
)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


@_query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@_query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@_query(
    "op9_line_dedup",
    r"""
    WITH d AS (
      SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls
      FROM documents),
    l AS (SELECT doc_id, r, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
    k AS (
      SELECT doc_id, r, i, line, translate(
        regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    common AS (
      SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
    SELECT doc_id, count(*) AS n_lines,
           count(*) FILTER (c.key IS NOT NULL) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (c.key IS NULL), ''))
             AS kept_sha256
    FROM k LEFT JOIN common c USING (key) GROUP BY doc_id, r""",
)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_common_lines(documents(spark, sf_dir).select("doc_id", "text")).selectExpr(
        "doc_id",
        "_n_lines AS n_lines",
        "_n_dropped AS n_dropped",
        "_kept_sha256 AS kept_sha256",
    )


@_query("op10_ngram_join")
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(documents(spark, sf_dir))


@_query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_verdicts(docs, fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@_query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    sample = training_sample(docs)
    texts, langs = (sample.column(c).to_pylist() for c in ("text", "lang"))
    return identify_language(docs, train(texts, langs) if texts else None)


@_query("op6_mix_sources")
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).drop("copies")


@_query("op3_substring_dedup")
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_windows(documents(spark, sf_dir)).drop("kept_text")


@_query("op2_sanitise")
def op2_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = private_spans(documents(spark, sf_dir))
    return spans.select("doc_id", *[c.alias(name) for name, c in span_columns().items()])


@_query("op11_tokenizer_alignment")
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


@_query("op12_quality_classifier")
def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = materialised(document_statistics(documents(spark, sf_dir)))
    return score_quality(table, fit_discriminant(table, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@_query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))
