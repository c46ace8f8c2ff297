"""Language identification: averaged subword embeddings and a linear softmax.

A word gives hashed byte n-grams with marks at its ends; a text is the average
of their embeddings, a linear layer and softmax on top. Both are trained by
stochastic gradient descent in numpy on a bounded sample. For prediction the
two layers are multiplied into one table of a few numbers per bucket; a task
scores each distinct word of a slice once. Scores are calibrated with a
temperature on rows kept out of training; the score below which only few
right answers fall there marks rejected rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from contactmine.llm.textbytes import LOWER, Texts, mix, slices, span_hashes
from contactmine.operators.frontier import cap_per_group

PER_LANGUAGE = 400  # documents of the training sample, fewer where there are many languages
SAMPLE = 80_000  # documents of all languages together; every language has one at least
SAMPLE_BYTES = 256 << 20  # of these texts together
BUCKETS = 1 << 14
NGRAMS = (2, 3, 4)
_OPEN, _CLOSE = 60, 62  # < and >


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string")) % 4 == 2, F.lit(False))


def _word_grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words, and the first of each word (and the end)."""
    sizes = ends - starts + 2
    base = np.concatenate([[0], np.cumsum(sizes)])
    word = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(base[-1]) - base[word]
    source = np.clip(starts[word] + inside - 1, 0, max(len(data) - 1, 0))
    marked = LOWER[data[source]] if len(data) else np.zeros(0, np.uint8)
    marked[inside == 0] = _OPEN
    marked[inside == sizes[word] - 1] = _CLOSE
    buckets, owners = [], []
    for n in NGRAMS:
        at = np.flatnonzero(inside + n <= sizes[word])
        buckets.append((span_hashes(marked, at, at + n) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(word[at])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(sizes))
    return np.concatenate(buckets)[order], np.concatenate([[0], np.cumsum(counts)])


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of rows of ``values`` between consecutive places of ``first``."""
    total = np.concatenate([np.zeros((1, values.shape[1])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


@dataclass
class LanguageModel:
    names: list[str]
    table: np.ndarray  # buckets x width: embedding; or that times the output layer, if narrower
    outer: np.ndarray | None  # width x languages: output layer, unless in the table
    bias: np.ndarray
    temperature: float
    least: float  # calibrated score of rejected rows

    def logits(self, part: Texts) -> np.ndarray:
        starts, ends, first = part.words()
        words = span_hashes(LOWER[part.data], starts, ends)
        _, at, inverse = np.unique(words, return_index=True, return_inverse=True)
        grams, edge = _word_grams(part.data, starts[at], ends[at])
        counts = _sums(np.diff(edge).astype(float)[inverse, None], first)
        # A few columns at a time: n-grams take many times the memory of the text.
        few = [self.table[:, c : c + 4] for c in range(0, self.table.shape[1], 4)]
        whole = np.concatenate([_sums(_sums(columns[grams], edge)[inverse], first) for columns in few], axis=1)
        mean = whole / np.maximum(counts, 1)
        return (mean if self.outer is None else mean @ self.outer) + self.bias

    def predict(self, part: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language and its calibrated probability."""
        chance = _softmax(self.logits(part) / self.temperature)
        best = chance.argmax(axis=1)
        return best, chance[np.arange(len(best)), best]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    texts: list[str], langs: list[str], width: int = 16, epochs: int = 12, rate: float = 0.5, seed: int = 1
) -> LanguageModel:
    """Fit on four of five texts, calibrate on the fifth ones."""
    names = sorted(set(langs))
    # Small slices: n-grams take many times the memory of the text.
    parts = [part for _, _, part in slices(pa.array(texts), 1 << 18)]
    bags = []
    for part in parts:
        starts, ends, first = part.words()
        grams, edge = _word_grams(part.data, starts, ends)
        spans = edge[first]
        bags += [np.unique(grams[a:b], return_counts=True) for a, b in zip(spans[:-1], spans[1:], strict=True)]
    label = np.searchsorted(names, langs)
    rng = np.random.default_rng(seed)
    kept_out = np.arange(len(texts)) % 5 == 4
    kept_out &= np.bincount(label[~kept_out], minlength=len(names))[label] > 0
    learn = np.flatnonzero(~kept_out)
    inner = rng.normal(0, 0.1, (BUCKETS, width))
    outer = np.zeros((width, len(names)))
    bias = np.zeros(len(names))
    for epoch in range(epochs):
        pace = rate * (1 - epoch / epochs)
        for k in rng.permutation(learn):
            where, count = bags[k]
            if not len(where):
                continue
            share = count / count.sum()
            mean = share @ inner[where]
            error = _softmax((mean @ outer + bias)[None])[0]
            error[label[k]] -= 1
            back = outer @ error
            outer -= pace * np.outer(mean, error)
            bias -= 0.1 * pace * error
            # A bucket seldom met would hardly move by its share of one text alone.
            inner[where] -= pace * 20 * np.outer(share, back)
    layers = (inner, outer) if len(names) > width else (inner @ outer, None)
    model = LanguageModel(names, *layers, bias, 1.0, 0.0)
    test = np.flatnonzero(kept_out)
    if len(test):
        logits = np.concatenate([model.logits(part) for part in parts])[test]
        own = np.arange(len(test)), label[test]
        heats = np.geomspace(0.05, 5, 40)
        losses = [-np.log(_softmax(logits / t)[own] + 1e-12).mean() for t in heats]
        model.temperature = float(heats[int(np.argmin(losses))])
        chance = _softmax(logits / model.temperature)
        right = chance.argmax(axis=1) == label[test]
        if right.any():
            model.least = float(np.quantile(chance.max(axis=1)[right], 0.01))
    return model


def training_sample(
    docs: DataFrame, per_language: int = PER_LANGUAGE, most_bytes: int = SAMPLE_BYTES
) -> pa.Table:
    """Texts and languages: of every language so many rows at most, the smallest hashes of ids.

    A language's share of ``most_bytes`` ends its rows earlier; its first row is always
    taken, and rows alike once. A count by the leading bits of the hash says how far the hashes may go, so
    that only about so many rows of a language are ranked, however many it has.
    """
    usable = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    ).where(~held_out(F.col("doc_id")))
    languages = max(1, usable.select("lang").distinct().count())
    per_language = max(1, min(per_language, SAMPLE // languages))
    usable = usable.select("doc_id", "lang", "text", F.xxhash64("text").alias("_key"))
    narrow = usable.select("doc_id", "lang", "_key", F.octet_length("text").cast("long").alias("_bytes"))
    narrow = narrow.withColumn("_hash", F.xxhash64("doc_id")).withColumn("_lead", F.shiftright("_hash", 56))
    upwards = Window.partitionBy("lang").orderBy("_lead")
    reach = (
        narrow.groupBy("lang", "_lead")
        .agg(F.approx_count_distinct("_hash", 0.05).alias("n"))  # repeated rows fill no place
        .withColumn("before", F.sum("n").over(upwards) - F.col("n"))
        .where(0.8 * F.col("before") < per_language)
        .groupBy("lang")
        .agg(F.max("_lead").alias("_reach"))
    )
    if languages <= SAMPLE:
        reach = F.broadcast(reach)
    near = narrow.join(reach, "lang").where(F.col("_lead") <= F.col("_reach")).distinct()
    order = ["_hash", "doc_id", "_key"]
    rank = Window.partitionBy("lang").orderBy(*order)
    chosen = (
        cap_per_group(near, ["lang"], per_language, order)
        .withColumn("_sum", F.sum("_bytes").over(rank.rowsBetween(Window.unboundedPreceding, 0)))
        .where((F.col("_sum") <= most_bytes // languages) | (F.col("_sum") == F.col("_bytes")))
    )
    same = ["doc_id", "lang", "_key"]
    texts = usable.join(F.broadcast(chosen.select(*same)), same, "left_semi").dropDuplicates(same)
    found = texts.select("doc_id", "lang", "text").toArrow()
    return found.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def identify_language(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``rejected``: one row per row of ``docs``.

    ``docs`` has doc_id and text; the prediction sees the text alone. ``und`` with
    score 0 where the text is null or has no letter (or nothing was learned);
    ``rejected`` where the calibrated score is as low as one in a hundred right
    answers, and for ``und``. Repeated rows and null ids are rows like any other
    (a null id is not held out); an empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, part in slices(batch.column(2)):
                letter = batch.column(3).slice(low, high - low).to_numpy(zero_copy_only=False)
                if model is None:
                    best, score = np.zeros(len(part), int), np.zeros(len(part))
                    letter = np.zeros(len(part), bool)
                else:
                    best, score = model.predict(part)
                names = pa.array(model.names if model else ["und"])
                yield pa.record_batch(
                    [
                        batch.column(0).slice(low, high - low),
                        batch.column(1).slice(low, high - low),
                        pc.if_else(pa.array(letter), names.take(pa.array(best)), "und"),
                        pa.array(np.where(letter, np.clip(score, 0, 1), 0.0)),
                        pa.array(~letter | (score < (model.least if model else 1))),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score", "rejected"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("doc_id", held_out(F.col("doc_id")), "text", has_letter).mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean"
    )
