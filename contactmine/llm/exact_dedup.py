"""Exact dedup by deterministic block naming.

Every normalised text is cut into blocks of a fixed number of code points.
Blocks are sorted into integer names, then adjacent names are paired and the
pairs sorted into names again, until each text has one name. Equal names mean
equal texts: a name stands for a block by its characters (64-bit fingerprint
first, the characters themselves where fingerprints tie), a pair's name for
exactly two names below it.

Text is shuffled once, one copy of a block per map task; everything after it is
a few numbers per block. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from contactmine.llm.scratch import materialised

BLOCK = 4096  # code points
# Two of n blocks share a 64-bit fingerprint by chance with n^2 / 2^65: a few
# hundred times in 10^11 blocks. More ties than this are joined, not broadcast.
MOST_TIES = 10_000


def normalised(text: Column) -> Column:
    """``text`` without any of ``[\\x20\\x09-\\x0D]``; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _blocks(docs: DataFrame, text: str, block: int) -> DataFrame:
    """``_key``, ``_pos``, ``_last``, ``_block``: the blocks of each text, one at least."""
    cut = F.regexp_extract_all(
        normalised(F.col(text)), F.lit(f"(?s).{{1,{block}}}"), F.lit(0)
    )
    return (
        docs.select("_key", cut.alias("_cut"))
        .select(
            "_key",
            (F.greatest(F.size("_cut"), F.lit(1)) - 1).alias("_last"),
            F.posexplode_outer("_cut").alias("_pos", "_block"),
        )
        .withColumns(
            {
                "_pos": F.coalesce("_pos", F.lit(0)),
                "_block": F.coalesce("_block", F.lit("")),
                "_print": F.xxhash64(F.coalesce("_block", F.lit(""))),
            }
        )
    )


def _named(pairs: DataFrame) -> DataFrame:
    """``pairs`` with an integer name for each distinct (_left, _right), in sorted order.

    Range partitions in order, rows in order: the running id is a rank with
    gaps. Written down at once, so that a retried task finds the same names.
    """
    ordered = (
        pairs.select("_left", "_right")
        .distinct()
        .repartitionByRange("_left", "_right")
        .sortWithinPartitions("_left", "_right")
    )
    names = materialised(ordered.withColumn("_name", F.monotonically_increasing_id()))
    return materialised(
        pairs.join(names, ["_left", "_right"]).select("_key", "_pos", "_last", "_name")
    )


def block_names(docs: DataFrame, text: str = "text", block: int = BLOCK) -> DataFrame:
    """``_key``, ``_last``, ``_name`` per row of ``docs``, whose keys have one text each.

    (_last, _name) are equal exactly where the normalised texts are: texts of as
    many blocks are paired as many times.
    """
    blocks = _blocks(docs, text, block)
    # Distinct blocks meet by fingerprint; copies collapse before the shuffle.
    ties = materialised(
        blocks.groupBy("_print")
        .agg(F.collect_set("_block").alias("_texts"))
        .where(F.size("_texts") > 1)
        .select("_print", F.array_sort("_texts").alias("_texts"))
    )
    few = ties.count() <= MOST_TIES
    level = materialised(
        blocks.join(F.broadcast(ties) if few else ties, "_print", "left").select(
            "_key",
            "_pos",
            "_last",
            F.col("_print").alias("_left"),
            # the place among the blocks of this fingerprint
            F.coalesce(F.array_position("_texts", F.col("_block")), F.lit(1)).alias(
                "_right"
            ),
        )
    )
    last = level.agg(F.max("_last")).first()[0] or 0
    level = _named(level)
    done = level.where(F.col("_last") == 0)
    width = 1
    while last >= width:
        odd = F.col("_pos") % 2 == 1
        pairs = (
            level.where(F.col("_last") >= width)
            .groupBy("_key", "_last", F.expr("_pos div 2").cast("int").alias("_pos"))
            .agg(
                F.max(F.when(~odd, F.col("_name"))).alias("_left"),
                F.coalesce(F.max(F.when(odd, F.col("_name"))), F.lit(-1)).alias("_right"),
            )
        )
        level = _named(materialised(pairs))
        width *= 2
        done = done.union(level.where(F.col("_last") < width))
    return done.select("_key", "_last", "_name")


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs``: which copy of its text stays.

    ``doc_id``, ``keep_id``, ``group_size`` (rows), ``kept``, ``text_sha256`` of the
    normalised text. Of equal texts the row with most code points stays, then
    the smallest id. Null text is empty; empty texts are equal to each other. A
    null id is an id like any other, smaller than all; rows that repeat an id
    *and* a text are one document and are kept or dropped together. Other
    columns are ignored; an empty table gives an empty table.
    """
    rows = docs.select(
        F.col(id_column).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")
    ).withColumn("_key", F.struct("_id", F.xxhash64("_text").alias("print")))
    plain = rows.select(
        F.col("_id").alias("doc_id"),
        "_key",
        F.char_length("_text").alias("_chars"),
        F.sha2(normalised(F.col("_text")), 256).alias("text_sha256"),
    )
    named = block_names(rows, "_text", block)
    # Names are per distinct (id, text); repeated rows meet them once each.
    joined = materialised(
        plain.join(named.dropDuplicates(["_key"]), "_key").drop("_key")
    )
    # Written down, so that the join has its own shuffle of the rows, in which Spark may split a large group.
    best = materialised(
        joined.groupBy("_last", "_name").agg(
            F.min_by("doc_id", F.struct(-F.col("_chars"), F.col("doc_id"))).alias("keep_id"),
            F.count(F.lit(1)).alias("group_size"),
        )
    )
    return joined.join(best, ["_last", "_name"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
