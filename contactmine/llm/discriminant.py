"""Quality classifier: regularised quadratic discriminant over document statistics.

Tasks count statistics of whole texts with numpy and transform them so that they
are nearly normal. Of the labelled documents only sums leave a task: count, sum
and products of the statistics of each class, a few hundred numbers, so that the
fit covers every labelled row and nothing grows on the driver. Each class has its
own covariance, shrunk towards the pooled one and towards its mean variance; its
Cholesky factor is computed once and travels with the tasks. A document's score is
the logistic of the difference of log densities (Mahalanobis distance and log
determinant), divided by a fixed factor, plus the log prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from contactmine.llm.textbytes import SPACE, Texts, mix, rows_of, slices, span_hashes, window_hashes, window_starts

_KINDS = {"letters": b"abcdefghijklmnopqrstuvwxyz", "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789",
          "stops": b".,;:!?'\"()-"}
STATISTICS = [
    "words", "word_mean", "word_spread", "capitals", "digits", "stops", "symbols", "distinct", "repeats",
    "same_lines", "line_words", "short_words", "longest_word",
]


def held_out(id_column: Column) -> Column:
    """Rows that no label is learned from; a null id is not one of them."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(False))


def transformed_statistics(part: Texts) -> np.ndarray:
    """Texts x statistics: logarithms of sizes, arcsines of roots of shares."""
    data, size = part.data, len(part)
    starts, ends, first = part.words()
    rows, lengths = rows_of(first), ends - starts
    n = np.diff(first)
    some = np.maximum(n, 1)

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[part.offsets[1:]] - sums[part.offsets[:-1]]

    def per_word(values: np.ndarray) -> np.ndarray:
        return np.bincount(rows, values, size)

    def share(count: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.arcsin(np.sqrt(np.clip(count / np.maximum(of, 1), 0, 1)))

    dark = ~SPACE[data]
    chars = per_text(dark)
    kinds = np.zeros(256, np.uint8)
    for k, members in enumerate(_KINDS.values()):
        kinds[[*members]] = k + 1
    kind = kinds[data]
    of_kind = [per_text(kind == k) for k in range(1, 5)]
    symbols = per_text(dark & (kind == 0) & (data < 128))
    mean = per_word(lengths) / some
    spread = np.sqrt(np.maximum(per_word(lengths.astype(float) ** 2) / some - mean**2, 0))
    longest = np.zeros(size)
    np.maximum.at(longest, rows, lengths)
    words = span_hashes(data, starts, ends)

    def firsts(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """How many different keys each text has."""
        _, at = np.unique(mix(keys + mix(owner)), return_index=True)
        return np.bincount(owner[at], minlength=size)

    at = window_starts(first, 3)
    threes = window_hashes(words, 3)[at]
    n_threes = np.bincount(rows[at], minlength=size)
    l_starts, l_ends, l_first = part.lines()
    filled = np.concatenate([[0], np.cumsum(dark)])
    full = filled[l_ends] > filled[l_starts]
    own = rows_of(l_first)[full]
    n_lines = np.bincount(own, minlength=size)
    lines = firsts(span_hashes(data, l_starts[full], l_ends[full]), own)
    return np.stack(
        [
            np.log1p(n), np.log1p(mean), np.log1p(spread),
            share(of_kind[1], chars), share(of_kind[2], chars), share(of_kind[3], chars), share(symbols, chars),
            share(firsts(words, rows), n), share(n_threes - firsts(threes, rows[at]), n_threes),
            share(n_lines - lines, n_lines), np.log1p(n / np.maximum(n_lines, 1)),
            share(per_word(lengths <= 3), n), np.log1p(longest),
        ],
        1,
    )


@dataclass
class Discriminant:
    """Two normal densities; class 1 second. ``factors``: lower Cholesky factors of the covariances."""

    center: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    prior: float  # log odds of class 1
    temper: float

    def logits(self, statistics: np.ndarray) -> np.ndarray:
        z = (statistics - self.center) / self.scale
        density = []
        for mean, factor in zip(self.means, self.factors, strict=True):
            white = np.linalg.solve(factor, (z - mean).T)
            density.append(-0.5 * (white**2).sum(axis=0) - np.log(np.diag(factor)).sum())
        return (density[1] - density[0]) / self.temper + self.prior

    def scores(self, statistics: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(statistics), -40, 40)))


def document_statistics(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``statistics``: one narrow row per row of ``docs``.

    Null is an empty text, whose statistics are zeros. Very long texts are read
    whole. Repeated rows and null ids are rows like any other (a null id is not
    held out); other columns are ignored; an empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, part in slices(batch.column(2)):
                values = pa.array(transformed_statistics(part).reshape(-1))
                edges = pa.array(np.arange(high - low + 1, dtype=np.int32) * len(STATISTICS))
                columns = [batch.column(k).slice(low, high - low) for k in (0, 1)]
                yield pa.record_batch([*columns, pa.ListArray.from_arrays(edges, values)], names)

    names = ["doc_id", "held_out", "statistics"]
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("doc_id"), held_out(F.col(id_column)).alias("held_out"), F.col(text))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, statistics array<double>")


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, len(STATISTICS))


def class_sums(table: DataFrame, labels: DataFrame) -> DataFrame:
    """``label``, ``place``, ``value``: count, sums and products of each class, summed over all its documents.

    ``table``: statistics of documents. Of several labels of one id the smallest
    counts, and each of its rows.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("label"))
    )
    rows = table.where("NOT held_out").join(known, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(STATISTICS) + 1
        total = np.zeros((2, width, width))
        for batch in batches:
            label = batch.column(1).to_numpy()
            rows = np.column_stack([np.ones(len(label)), _matrix(batch.column(0))])
            for k in (0, 1):
                total[k] += rows[label == k].T @ rows[label == k]
        yield pa.record_batch(
            [
                pa.array(np.repeat([0, 1], width**2).astype(np.int32)),
                pa.array(np.tile(np.arange(width**2, dtype=np.int32), 2)),
                pa.array(total.reshape(-1)),
            ],
            ["label", "place", "value"],
        )

    sums = rows.select("statistics", "label").mapInArrow(run, "label int, place int, value double")
    # Decimal sums, so that the order of tasks cannot change the model.
    return sums.groupBy("label", "place").agg(F.sum(F.col("value").cast("decimal(38,12)")).alias("value"))


def fit(sums: np.ndarray, shrink: float = 0.5, ridge: float = 0.05, temper: float = 4.0) -> Discriminant | None:
    """The model from the products of (1, statistics) per class; None without rows of both classes.

    ``shrink``: share of the pooled covariance, more for a class of few rows;
    ``ridge``: share of the mean variance; ``temper``: divides the difference of log
    densities, as statistics of one text are not independent.
    """
    counts = sums[:, 0, 0]
    if counts.min() < 1:
        return None
    whole = sums.sum(axis=0)
    center = whole[0, 1:] / whole[0, 0]
    spread = np.diag(whole)[1:] / whole[0, 0] - center**2
    scale = np.sqrt(np.maximum(spread, 1e-6))
    size = len(center)
    means, scatter = [], []
    for total in sums:
        mean = total[0, 1:] / total[0, 0]
        centered = total[1:, 1:] - total[0, 0] * np.outer(mean, mean)
        means.append((mean - center) / scale)
        scatter.append(centered / np.outer(scale, scale))
    pooled = sum(scatter) / counts.sum()
    factors = []
    for total, n in zip(scatter, counts, strict=True):
        part = min(1.0, max(shrink, size / n))
        own = (1 - part) * total / n + part * pooled
        own = (1 - ridge) * own + (ridge * max(np.trace(own) / size, 1e-3)) * np.eye(size)
        factors.append(np.linalg.cholesky((own + own.T) / 2))
    prior = float(np.log(counts[1] / counts[0]))
    return Discriminant(center, scale, np.array(means), np.array(factors), prior, temper)


def fit_discriminant(table: DataFrame, labels: DataFrame) -> Discriminant | None:
    """The model of all labelled documents that are not held out."""
    width = len(STATISTICS) + 1
    sums = np.zeros((2, width * width))
    for row in class_sums(table, labels).collect():  # two tables of a fixed size
        sums[row["label"], row["place"]] = float(row["value"])
    return fit(sums.reshape(2, width, width))


def score_quality(table: DataFrame, model: Discriminant | None, least: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``: one row per row of ``table``, statistics of documents.

    ``score`` is 0 to 1, higher where label 1 is likelier; ``predicted`` 1 from
    ``least`` on. Without a model all scores are 0.5.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column(2))
            score = np.round(model.scores(values), 9) if model else np.full(len(values), 0.5)
            predicted = pa.array((score >= least).astype(np.int32))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(score), predicted],
                ["doc_id", "held_out", "score", "predicted"],
            )

    kind = table.schema["doc_id"].dataType.simpleString()
    return table.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
