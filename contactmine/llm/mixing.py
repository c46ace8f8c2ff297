"""Mixing sources to target weights by cube-method balanced sampling.

A source's target over its size says how often each of its documents is taken:
so many whole times, and once more with the fractional rest as inclusion
probability. The cube method decides the rests: three documents at a time move
along the null space of the two balancing constraints (words taken, documents
taken) until one of them is in or out. Both totals stay as they are, whatever
is drawn. Groups of a few thousand documents fly side by side; the two or so
documents each leaves open fly again together, until one small landing problem
per source remains: what is still open is decided by chance, and a few hundred
smaller documents that waited take up the words this is off by.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from contactmine.llm.scratch import materialised
from contactmine.llm.textbytes import slices

WEIGHTS = (5, 2, 1)
GROUP = 4096
POOL = 256  # documents of a source that wait for the landing, about
_CLOSE = 1e-9


def fly(sizes: list[int], chances: list[float], seed: str, land: bool = False) -> list[float]:
    """Move ``chances`` to 0 or 1, keeping their sum and their sum times ``sizes``.

    At most two stay in between; with ``land`` these are decided too, first
    keeping the sum only, the last one by chance.
    """
    draw = random.Random(seed).random
    out = list(chances)
    active: list[int] = []
    waiting = iter(k for k, p in enumerate(out) if 0.0 < p < 1.0)

    def move(units: list[int], along: list[float]) -> None:
        up = min(((1 - out[k]) / u if u > 0 else out[k] / -u) for k, u in zip(units, along, strict=True) if u)
        down = min((out[k] / u if u > 0 else (1 - out[k]) / -u) for k, u in zip(units, along, strict=True) if u)
        step = up if draw() * (up + down) < down else -down
        for k, u in zip(units, along, strict=True):
            p = out[k] + step * u
            out[k] = 0.0 if p < _CLOSE else 1.0 if p > 1 - _CLOSE else p

    while True:
        active = [k for k in active if 0.0 < out[k] < 1.0]
        while len(active) < 3:
            k = next(waiting, None)
            if k is None:
                break
            active.append(k)
        if len(active) == 3:
            a, b, c = (float(sizes[k]) for k in active)
            along = [b - c, c - a, a - b]
            move(active, along if any(along) else [1.0, -1.0, 0.0])
        elif len(active) == 2 and (land or sizes[active[0]] == sizes[active[1]]):
            move(active, [1.0, -1.0])
        else:
            break
    if land:
        for k in active:
            out[k] = float(draw() < out[k])
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, source) with ``size``, the words of the text, for the text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, part in slices(batch.column(1)):
                yield pa.record_batch(
                    [
                        batch.column(0).slice(low, high - low),
                        batch.column(2).slice(low, high - low),
                        pa.array(np.diff(part.words()[2]).astype(np.int64)),
                    ],
                    ["doc_id", "source", "size"],
                )

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", "source"))
    return docs.select("doc_id", "text", "source").mapInArrow(count, f"{kinds}, size long")


def source_targets(sizes: DataFrame, share: float, most: float, weights: tuple = WEIGHTS) -> DataFrame:
    """``source``, ``source_size``, ``docs``, ``target``: one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` times all words; no target is above ``most`` times its source: what
    is over goes to the others by weight until none is above, which is one level
    for all sources below their limit. The windows run over one row per source.
    """
    sources = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    sources = materialised(
        sources.withColumn("w", weight.cast("double")).withColumn("most", F.col("source_size") * most)
    )
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    order = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.lit(total) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(after)
    levels = sources.withColumn("level", level).where(F.col("most") > F.col("level") * F.col("w"))
    best = levels.agg(F.max("level")).first()[0]
    target = F.col("most") if best is None else F.least("most", F.col("w") * best)
    return sources.select("source", "source_size", "docs", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    share: float = 1.5,
    most: float = 2.0,
    weights: tuple = WEIGHTS,
    seed: int = 0,
) -> DataFrame:
    """``doc_id``, ``size``, ``source``, ``source_size``, ``target``, ``copies``, ``taken``.

    One row per row of ``docs``: ``copies`` of it are taken, ``taken`` words in all,
    at most ``most`` times its size. Null text has no words; a null source is a
    source of its own, the last. Repeated rows and null ids are documents of
    their own. The same rows and seed give the same mix. Other columns are
    ignored; an empty table gives an empty table.
    """
    docs = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source")
    )
    sizes = materialised(word_counts(docs))
    targets = materialised(source_targets(sizes, share, most, weights))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = sizes.join(
        targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")
    turn = F.xxhash64("doc_id", F.lit(seed))
    # Some documents of at most average size wait for the landing.
    waits = (F.pmod(turn, F.expr(f"docs div {POOL} + 1")) == 0) & (
        F.col("size") * F.col("docs") <= F.col("source_size")
    )
    bucket = F.pmod(F.xxhash64(turn), F.expr(f"docs div {GROUP} + 1"))
    state = joined.select(
        "doc_id", "source", "size", "source_size", "target",
        F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("chance"),
        F.when(waits, F.lit(-1)).otherwise(bucket).alias("bucket"),
    )
    schema = state.schema

    def ordered(table: pa.Table) -> tuple[list[int], list[int], list[float], str]:
        """Rows in one random order, whatever the order of arrival."""
        name = f"{seed}/{table.column('source')[0]}/{table.column('bucket')[0]}"
        rows = list(zip(*(table.column(c).to_pylist() for c in ("doc_id", "size", "chance")), strict=True))
        order = sorted(range(len(rows)), key=lambda k: tuple((x is not None, x) for x in rows[k]))
        random.Random(name).shuffle(order)
        return order, [rows[k][1] for k in order], [rows[k][2] for k in order], name

    def decided(table: pa.Table, order: list[int], chances: list[float]) -> pa.Table:
        out = np.empty(len(order))
        out[order] = chances
        return table.set_column(table.schema.get_field_index("chance"), "chance", pa.array(out))

    def flight(table: pa.Table) -> pa.Table:
        order, sizes, chances, name = ordered(table)
        return decided(table, order, fly(sizes, chances, name))

    def landing(table: pa.Table) -> pa.Table:
        """Decide what is open, then let the waiting documents make up for the error."""
        order, sizes, chances, name = ordered(table)
        buckets = table.column("bucket").to_pylist()
        waiting = [k for k, row in enumerate(order) if buckets[row] < 0]
        others = [k for k, row in enumerate(order) if buckets[row] >= 0]
        landed = fly([sizes[k] for k in others], [chances[k] for k in others], name, land=True)
        error = sum(sizes[k] * (x - chances[k]) for k, x in zip(others, landed, strict=True))
        pool = [chances[k] for k in waiting]
        for _ in range(8):  # chances stay between 0 and 1, so a shift may fall short
            free = [i for i, k in enumerate(waiting) if sizes[k] and (pool[i] > 0 if error > 0 else pool[i] < 1)]
            room = sum(sizes[waiting[i]] for i in free)
            if abs(error) < 1e-6 or not room or not 0 < sum(pool) < len(pool):
                break
            shift = -error / room
            for i in free:
                moved = min(1.0, max(0.0, pool[i] + shift))
                error += sizes[waiting[i]] * (moved - pool[i])
                pool[i] = moved
        pool = fly([sizes[k] for k in waiting], pool, name + "/pool", land=True)
        for k, x in [*zip(others, landed, strict=True), *zip(waiting, pool, strict=True)]:
            chances[k] = x
        return decided(table, order, chances)

    is_open = (F.col("chance") > 0) & (F.col("chance") < 1)
    state = materialised(state)
    pool, state = state.where("bucket < 0"), state.where("bucket >= 0")
    done = []
    groups = (targets.agg(F.max("docs")).first()[0] or 0) // GROUP + 1
    while True:
        state = materialised(state.groupBy("source", "bucket").applyInArrow(flight, schema))
        done.append(state.where(~is_open))
        # At most two of a group are open: so many groups fly together next.
        state = state.where(is_open).withColumn("bucket", F.expr(f"bucket div {GROUP // 2}"))
        if groups == 1:
            break
        groups = (groups - 1) // (GROUP // 2) + 1
    landed = state.unionByName(pool).groupBy("source").applyInArrow(landing, schema)
    decided_rows = materialised(landed)
    for part in done:
        decided_rows = decided_rows.unionByName(part)
    copies = (F.col("whole") + F.round("chance")).cast("long")
    return decided_rows.select(
        "doc_id", "size", "source", "source_size", "target",
        copies.alias("copies"), (F.col("size") * copies).alias("taken"),
    )
