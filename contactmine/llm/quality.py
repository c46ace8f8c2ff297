"""Quality rules: gradient-boosted trees over document statistics.

Each task counts statistics of whole texts with numpy and scores them at once
with the trees, flattened into arrays of nodes. The trees are fitted on the
driver on a bounded sample of labelled rows. Some features may only ever lower
the score (repetition, symbols): splits that would raise it are not taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from contactmine.llm.textbytes import (
    SPACE,
    Texts,
    mix,
    repeated,
    rows_of,
    slices,
    span_hashes,
    window_hashes,
    window_starts,
)

LABELLED = 20_000  # rows of the sample at most
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[*b"#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_HEAD = np.ones(256, bool)  # bytes that begin a character
_HEAD[0x80:0xC0] = False

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Feature names and how the score may move with them: -1 down only, 0 freely.
FEATURES = {
    "log_words": 0,
    "mean_word": 0,
    "symbols": -1,
    "dup_lines": -1,
    "repeats": -1,
    "distinct": 0,
    "upper": 0,
    "digits": -1,
    "words_per_line": 0,
}


def statistics(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Base counts (texts x 5) and features (texts x features)."""
    starts, ends, first = part.words()
    rows = rows_of(first)
    size = len(part)
    n_words = np.diff(first)

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[part.offsets[1:]] - sums[part.offsets[:-1]]

    word_chars = per_text(_HEAD[part.data] & ~SPACE[part.data])
    symbols = per_text(SYMBOLS[part.data])
    words = span_hashes(part.data, starts, ends)
    tagged = mix(words + mix(rows))  # equal words of one text only
    again = np.bincount(rows[repeated(tagged)], minlength=size)
    at = window_starts(first, 3)
    windows = window_hashes(words, 3)[at]
    twice = at[repeated(mix(windows + mix(rows[at])))]
    hit = np.zeros(len(words), bool)
    for shift in range(3):
        hit[twice + shift] = True
    n_repeat = np.bincount(rows[hit], minlength=size)
    l_starts, l_ends, l_first = part.lines()
    own = rows_of(l_first)
    dark = np.concatenate([[0], np.cumsum(~SPACE[part.data])])
    full = dark[l_ends] > dark[l_starts]
    keys = mix(span_hashes(part.data, l_starts[full], l_ends[full]) + mix(own[full]))
    _, seen = np.unique(keys, return_index=True)
    later = np.ones(len(keys), bool)
    later[seen] = False
    n_dup = np.bincount(own[full][later], minlength=size)
    n_lines = np.bincount(own[full], minlength=size)
    some, chars, lines = np.maximum(n_words, 1), np.maximum(word_chars, 1), np.maximum(n_lines, 1)
    base = np.stack([n_words, word_chars, symbols, n_dup, n_repeat], 1).astype(np.int64)
    features = np.stack(
        [
            np.log1p(n_words), word_chars / some, symbols / chars, n_dup / lines, n_repeat / some,
            1 - again / some, per_text(_UPPER[part.data]) / chars, per_text(_DIGIT[part.data]) / chars,
            n_words / lines,
        ],
        1,
    )
    return base, features


@dataclass
class Trees:
    """All trees in flat arrays; a leaf has feature -1. ``roots``: each tree's first node."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, features: np.ndarray) -> np.ndarray:
        """Log odds of good quality."""
        out = np.full(len(features), self.start)
        each = np.arange(len(features))
        for root in self.roots.tolist():
            node = np.full(len(features), root)
            for _ in range(self.depth):
                column = self.feature[node]
                inner = column >= 0
                right = features[each, np.maximum(column, 0)] > self.threshold[node]
                node = np.where(inner, np.where(right, self.right[node], self.left[node]), node)
            out += self.value[node]
        return out


def fit_trees(
    features: np.ndarray,
    good: np.ndarray,
    signs: list[int],
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.15,
    bins: int = 32,
    least: int = 10,
    smooth: float = 1.0,
) -> Trees:
    """Boosted trees for log loss, with Newton steps on quantile bins.

    ``signs``: +1 or -1 where the score may only rise or fall with a feature.
    """
    cuts = [np.unique(np.quantile(f, np.linspace(0, 1, bins + 1)[1:-1])) for f in features.T]
    binned = np.stack([np.searchsorted(c, f, side="left") for c, f in zip(cuts, features.T, strict=True)], 1)
    share = float(np.clip(good.mean(), 1e-3, 1 - 1e-3))
    start = float(np.log(share / (1 - share)))
    score = np.full(len(good), start)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots = []

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(g / (h + smooth), low, high))

    def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = gradient[rows], weight[rows]
        name = len(nodes)
        nodes.append([-1, 0.0, -1, -1, rate * leaf(g.sum(), h.sum(), low, high)])
        if level == depth or len(rows) < 2 * least:
            return name
        best, whole = (1e-6, None), g.sum() ** 2 / (h.sum() + smooth)
        for f, cut in enumerate(cuts):
            b = binned[rows, f]
            gs, hs, ns = (np.bincount(b, x, len(cut) + 1).cumsum()[:-1] for x in (g, h, None))
            gl, hl, gr, hr = gs, hs, g.sum() - gs, h.sum() - hs
            a = np.clip(gl / (hl + smooth), low, high)
            c = np.clip(gr / (hr + smooth), low, high)
            gain = gl**2 / (hl + smooth) + gr**2 / (hr + smooth) - whole
            gain[(ns < least) | (len(rows) - ns < least) | (signs[f] * (c - a) < 0)] = 0
            if len(gain) and gain.max() > best[0]:
                k = int(gain.argmax())
                best = (float(gain[k]), (f, k, (a[k] + c[k]) / 2))
        if best[1] is None:
            return name
        f, k, middle = best[1]
        goes = binned[rows, f] <= k
        bounds = ((low, high), (low, high))
        if signs[f] < 0:
            bounds = ((middle, high), (low, middle))
        elif signs[f] > 0:
            bounds = ((low, middle), (middle, high))
        left = grow(rows[goes], level + 1, *bounds[0])
        right = grow(rows[~goes], level + 1, *bounds[1])
        nodes[name] = [f, float(cuts[f][k]), left, right, 0.0]
        return name

    for _ in range(trees):
        chance = 1 / (1 + np.exp(-score))
        gradient, weight = good - chance, chance * (1 - chance)
        roots.append(len(nodes))
        grow(np.arange(len(good)), 0, -np.inf, np.inf)
        flat = _flat(start, roots[-1:], nodes, depth)
        score += flat.score(features) - start
    return _flat(start, roots, nodes, depth)


def _flat(start: float, roots: list[int], nodes: list, depth: int) -> Trees:
    table = np.array(nodes)
    return Trees(
        start, np.array(roots), table[:, 0].astype(int), table[:, 1],
        table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4], depth,
    )


def labelled_features(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Features and quality labels of at most ``most`` labelled rows, by hash of their id."""
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min(F.col("quality").cast("double")).alias("good"))  # of several labels the worst
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, part in slices(batch.column(0)):
                features = statistics(part)[1]
                yield pa.record_batch(
                    [batch.column(1).slice(low, high - low), pa.array(list(features), pa.list_(pa.float64()))],
                    ["good", "features"],
                )

    rows = texts.select("text", "good").mapInArrow(run, "good double, features array<double>")
    # Repeated ids could multiply the rows; the limit holds for what is collected.
    table = rows.limit(most).toArrow()
    features = np.array(table.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
    return features, table.column("good").to_numpy()


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> Trees | None:
    """Trees from the labelled documents; None where there are not both kinds of label."""
    features, good = labelled_features(docs, labels, most)
    order = np.lexsort((good, *features.T))  # the same trees whatever the order of rows
    features, good = features[order], good[order]
    if not len(good) or good.min() == good.max():
        return None
    return fit_trees(features, good, list(FEATURES.values()))


def quality_verdicts(
    docs: DataFrame,
    trees: Trees | None,
    id_column: str = "doc_id",
    text: str = "text",
    least_words: int = 50,
    most_repeats: int = 50,
    least_score: float = -2.0,
    keep_columns: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: counts, ``base_failed``, ``quality`` and ``kept``.

    ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``; ``base_failed`` below ``least_words`` words or above
    ``most_repeats`` percent of repeated words; ``quality`` the log odds of the
    trees (0 without trees); ``kept`` where the base holds and ``quality`` is at
    least ``least_score``: about one in eight is then good, so that doubtful
    documents stay. ``keep_columns`` gives the kept rows of ``docs`` instead, with their
    own columns, whatever those are called.
    Null text has no words and fails. Repeated rows and null
    ids are rows like any other; other columns are ignored; an empty table
    gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, part in slices(batch.column(at)):
                base, features = statistics(part)
                failed = (base[:, 0] < least_words) | (100 * base[:, 4] > most_repeats * base[:, 0])
                score = trees.score(features) if trees else np.zeros(len(base))
                kept = ~failed & (score >= least_score)
                if keep_columns:
                    yield batch.slice(low, high - low).filter(pa.array(kept))
                    continue
                yield pa.record_batch(
                    [
                        batch.column(0).slice(low, high - low),
                        *(pa.array(c) for c in base.T.copy()),
                        pa.array(failed),
                        pa.array(score),
                        pa.array(kept),
                    ],
                    ["doc_id", *BASE, "base_failed", "quality", "kept"],
                )

    at = docs.columns.index(text) if keep_columns else 1
    if keep_columns:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
        return docs.mapInArrow(run, fields)
    kind = docs.schema[id_column].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in BASE)
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text)).mapInArrow(
        run, f"doc_id {kind}, {counts}, base_failed boolean, quality double, kept boolean"
    )
