"""Running sums and ranks per group that survive one huge group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_BITS = 20


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; the key columns come from the left."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def _before(df: DataFrame, block: Sequence[str], by: str, out: str) -> DataFrame:
    """Sum of ``_v`` over the earlier rows of the same block."""
    window = (
        Window.partitionBy(*block)
        .orderBy(by)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return df.withColumn(out, F.coalesce(F.sum("_v").over(window), F.lit(0)))


def running_sum(
    df: DataFrame, keys: Sequence[str], order: str, value: Column, out: str = "total"
) -> DataFrame:
    """Running sum of ``value`` per group, in the order of a unique integer column.

    A window over the group would put the whole group in one task. Here the
    order column is cut into blocks of 2^20: rows sum within their block, and
    the block sums, a million times fewer, within their group. The group is one
    struct, which also finds its block where a key is NULL.
    """
    rows = df.withColumns(
        {
            "_g": F.struct(*[F.col(k) for k in keys], F.lit(0).alias("_all")),
            "_v": value.cast("long"),
            "_b": F.shiftright(F.col(order).cast("long"), _BITS),
        }
    )
    blocks = rows.groupBy("_g", "_b").agg(F.sum("_v").alias("_v"))
    blocks = _before(blocks, ["_g"], "_b", "_p1").drop("_v")
    within = (
        Window.partitionBy("_g", "_b")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = rows.withColumn("_p0", F.sum("_v").over(within))
    return summed.join(blocks, ["_g", "_b"]).select(
        *df.columns, (F.col("_p0") + F.col("_p1")).alias(out)
    )
