"""Keyword matching as relational operators."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator, Sequence
from itertools import islice

import ahocorasick
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from contactmine.functions.keywords import keyword_hits

# The scan travels with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def staged(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters use but do not compute again.

    A filter on a projected column is pushed below the projection together
    with a copy of its expression, once per use and without subexpression
    sharing. A one-row generator is a line the optimizer does not push such a
    filter across.
    """
    named = df.withColumns(columns)
    rest = [c for c in named.columns if c not in columns]
    return named.select(
        *rest, F.inline(F.array(F.struct(*[F.col(name) for name in columns])))
    )


def with_hits(df: DataFrame, text: str, keywords: Sequence[str]) -> DataFrame:
    """Add ``hits`` and keep the rows that have any."""
    return staged(df, hits=keyword_hits(F.col(text), keywords)).filter(
        F.size("hits") > 0
    )


# Keywords of so many characters together go into one automaton, some 100 MB at most.
AUTOMATON_CHARS = 1 << 20

# Up to this many different keyword beginnings are looked for while scanning.
_SCAN_ANCHORS = 200


def _anchored(keywords: DataFrame) -> DataFrame:
    lowered = keywords.withColumn("_kw", F.lower("kw")).filter(F.length("_kw") > 0)
    return lowered.withColumn("_anchor", F.left("_kw", F.lit(4)))


def _any_of(words: Sequence[str]) -> str:
    """A pattern for any of the words that compares each shared beginning once."""
    if "" in words:
        return ""
    rests: dict[str, list[str]] = {}
    for word in words:
        rests.setdefault(word[0], []).append(word[1:])
    branches = [
        (c if c.isascii() and c.isalnum() else rf"\x{{{ord(c):x}}}") + _any_of(rest)
        for c, rest in sorted(rests.items())
    ]
    return "(?:" + "|".join(branches) + ")"


def _stretches(text: Column, longest: int, anchors: Sequence[str] | None) -> Column:
    """Distinct stretches of text, long enough for any keyword, one per position.

    With ``anchors``, only from the positions where a keyword may begin.
    """
    begin = ""
    if anchors is not None:
        begin = f"(?={_any_of(anchors)})"
    found = F.regexp_extract_all(
        F.lower(text), F.lit(rf"(?s){begin}(?=(.{{1,{longest}}}))"), F.lit(1)
    )
    return F.array_distinct(found)


def _candidate_pairs(
    texts: DataFrame, keywords: DataFrame, key: str, text: str, how: str
) -> DataFrame:
    anchored = _anchored(keywords)
    stats = anchored.agg(
        F.max(F.length("_kw")).alias("longest"),
        F.collect_set(F.length("_anchor")).alias("sizes"),
    ).first()
    sizes = sorted(stats["sizes"]) or [1]
    # Many keywords: every position is tried and the join does the selection.
    few = anchored.select("_anchor").distinct().limit(_SCAN_ANCHORS + 1).collect()
    anchors = [row["_anchor"] for row in few]
    if len(anchors) > _SCAN_ANCHORS or not anchors:
        anchors = None
    stretches = _stretches(F.col(text), stats["longest"] or 1, anchors)
    windows = texts.select(F.col(key), F.explode(stretches).alias("_stretch"))
    # One equality key for all keywords: the anchor of every size that occurs.
    begins = F.array(*[F.left("_stretch", F.lit(n)) for n in sizes])
    windows = windows.select(
        key, "_stretch", F.explode(F.array_distinct(begins)).alias("_anchor")
    )
    return windows.join(
        anchored,
        (windows["_anchor"] == anchored["_anchor"])
        & F.startswith(windows["_stretch"], anchored["_kw"]),
        how,
    )


def _short_list(keywords: DataFrame) -> list[str] | None:
    """The distinct keywords in lower case, if one automaton can hold them all."""
    lowered = keywords.select(F.lower("kw").alias("_kw")).where("_kw <> ''").distinct()
    if (lowered.agg(F.sum(F.length("_kw"))).first()[0] or 0) > AUTOMATON_CHARS:
        return None
    return [row["_kw"] for row in lowered.collect()]


_automata: dict[str, ahocorasick.Automaton] = {}


def _automaton(name: str, words: Sequence[str]) -> ahocorasick.Automaton:
    """The automaton of a list of keywords, built once in each worker."""
    if name not in _automata:
        _automata.clear()
        automaton = ahocorasick.Automaton()
        for word in words:
            automaton.add_word(word, word)
        if words:
            automaton.make_automaton()
        _automata[name] = automaton
    return _automata[name]


def _scanned(texts: DataFrame, words: Sequence[str], key: str, text: str, pairs: bool) -> DataFrame:
    """Keys with each keyword their text holds, or, without ``pairs``, with the first one found."""
    name = uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(name, words)
        for batch in batches:
            owners, found = [], []
            for row, body in enumerate(batch.column(1)):
                matches = (word for _, word in automaton.iter(body.as_py() or "")) if words else iter(())
                own = set(matches) if pairs else set(islice(matches, 1))
                owners += [row] * len(own)
                found += own
            at = pa.array(owners, pa.int64())
            yield pa.record_batch([batch.column(0).take(at), pa.array(found, pa.string())], [key, "_kw"])

    kind = texts.schema[key].dataType.simpleString()
    return texts.select(key, F.lower(text)).mapInArrow(scan, f"`{key}` {kind}, _kw string")


def keyword_join(
    texts: DataFrame, keywords: DataFrame, key: str, text: str
) -> DataFrame:
    """Every (text, keyword) pair where the text contains the keyword, in any case.

    For keyword tables too long for an expression. One automaton over all keywords
    runs over each text once: its memory grows with the keywords' characters, not
    with the texts. It goes out with the tasks only up to ``AUTOMATON_CHARS``
    characters; more keywords meet stretches of the texts in an equality join on
    their first characters and are then compared in full. The text itself is
    never shuffled.
    """
    words = _short_list(keywords)
    if words is None:
        pairs = _candidate_pairs(texts, keywords, key, text, "inner")
        return pairs.select(key, *[pairs[c] for c in keywords.columns]).distinct()
    found = _scanned(texts, words, key, text, True).distinct()
    named = keywords.withColumn("_kw", F.lower("kw")).distinct()
    return found.join(named, "_kw").select(key, *[named[c] for c in keywords.columns])


def keyword_lists(pairs: DataFrame, key: str) -> DataFrame:
    """Pairs back to one ordered hit list per text; at most one entry per keyword."""
    ordered = F.array_sort(F.collect_list(F.struct("ord", "kw")))
    return pairs.groupBy(key).agg(F.transform(ordered, lambda x: x["kw"]).alias("hits"))


def keyword_semi(texts: DataFrame, keywords: DataFrame, key: str, text: str) -> DataFrame:
    """Keys of the texts that contain any keyword."""
    words = _short_list(keywords)
    if words is None:
        return _candidate_pairs(texts, keywords, key, text, "left_semi").select(key).distinct()
    return _scanned(texts, words, key, text, False).select(key).distinct()
