"""Substring dedup by recompression.

Words get names; rounds then rename runs of equal symbols and pairs of adjacent
ones (a symbol of the left half of the alphabet with one of the right half). A
name is a 64-bit hash of what it stands for, so equal runs and pairs have equal
names in every task without an exchange, and equal passages have equal symbols
inside, whatever surrounds them. Each symbol carries how far left and right the
parse that made it has looked.

A window of words is represented by one high-level symbol inside it that its own
words alone have determined: the one with the smallest name. Equal windows have
the same one, so windows travel to the shard of their symbol, all windows of one
occurrence together, as 48 bits of hash beside 16 bits of the symbol. Windows
that meet their like there are repeats; windows repeated within one slice are
sent once. Only keys and places of repeats come back to the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from contactmine.llm.scratch import shards_for
from contactmine.llm.textbytes import (
    U64,
    mix,
    repeated,
    rows_of,
    slices,
    span_hashes,
    window_hashes,
    window_starts,
)

WINDOW = 35
ROUNDS = 4
_PLACE = U64((1 << 28) - 1)


@dataclass
class Symbols:
    """A parse: names, the words [start, end) and what the parse looked at [low, high)."""

    name: np.ndarray
    start: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray
    text: np.ndarray  # the text each symbol belongs to


def _looks(s: Symbols, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``low`` of each symbol's left neighbour and ``high`` of its right one.

    At the edge of a text both lie outside it: no window can have seen the edge.
    """
    low = np.roll(s.low, 1)
    high = np.roll(s.high, -1)
    edge = np.ones(len(s.text) + 1, bool)
    edge[1:-1] = s.text[1:] != s.text[:-1]
    low[edge[:-1]] = first[s.text[edge[:-1]]] - 1
    high[edge[1:]] = first[s.text[edge[1:]] + 1] + 1
    return low, high


def _runs(s: Symbols, first: np.ndarray) -> Symbols:
    """Rename maximal runs of one symbol; that a run ends is seen on both sides."""
    low, high = _looks(s, first)
    new = np.ones(len(s.name), bool)
    new[1:] = (s.name[1:] != s.name[:-1]) | (s.text[1:] != s.text[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(new)) - 1 if len(head) else head
    count = (tail - head + 1).astype(U64)
    name = s.name[head]
    name = np.where(count > 1, mix(name + count * U64(0x9E6C63D0876A9A47)), name)
    return Symbols(name, s.start[head], s.end[tail], low[head], high[tail], s.text[head])


def _pairs(s: Symbols, first: np.ndarray, turn: int) -> Symbols:
    """Rename pairs of a left-half and a right-half symbol."""
    low, high = _looks(s, first)
    right = (mix(s.name + U64(turn)) & U64(1)).astype(bool)
    pair = np.zeros(len(right), bool)
    pair[:-1] = ~right[:-1] & right[1:] & (s.text[1:] == s.text[:-1])
    second = np.zeros(len(right), bool)
    second[1:] = pair[:-1]
    head = np.flatnonzero(~second)
    tail = head + pair[head]
    name = s.name[head]
    both = mix(name * U64(0xC2B2AE3D27D4EB4F) + mix(s.name[tail] + U64(turn)))
    name = np.where(pair[head], both, name)
    # A left-half symbol stays alone because of its right neighbour, and so on.
    alone = ~pair[head]
    left_look = np.where(alone & right[head], low[head], s.low[head])
    right_look = np.where(alone & ~right[head], high[head], s.high[tail])
    return Symbols(name, s.start[head], s.end[tail], left_look, right_look, s.text[head])


def parses(words: np.ndarray, first: np.ndarray, rounds: int = ROUNDS) -> list[Symbols]:
    """The parse of all texts after each round, the words themselves first."""
    at = np.arange(len(words))
    levels = [Symbols(words, at, at + 1, at, at + 1, rows_of(first))]
    for turn in range(rounds):
        levels.append(_pairs(_runs(levels[-1], first), first, turn + 1))
    return levels


def _least(key: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of ``key[low:high]`` for each (non-empty) range."""
    out = np.empty(len(low), U64)
    power = np.log2(high - low).astype(np.int64)
    table, width = key, 1
    for step in range(int(power.max(initial=0)) + 1):
        at = np.flatnonzero(power == step)
        out[at] = np.minimum(table[low[at]], table[high[at] - width])
        table = np.minimum(table[:-width], table[width:]) if len(table) > width else table
        width *= 2
    return out


def anchors(levels: list[Symbols], at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window start: the name of its symbol and where that starts.

    The highest level on which the window holds a symbol it has determined.
    """
    name, place = np.zeros(len(at), U64), np.zeros(len(at), np.int64)
    left = np.arange(len(at))
    for depth in range(len(levels) - 1, -1, -1):
        s = levels[depth]
        low = np.searchsorted(s.low, at[left], side="left")
        high = np.searchsorted(s.high, at[left] + length, side="right")
        some = high > low
        # Smallest name, the first of equal ones.
        key = (s.name & ~_PLACE) | np.arange(len(s.name)).astype(U64)
        best = (_least(key, low[some], high[some]) & _PLACE).astype(np.int64)
        name[left[some]] = mix(s.name[best] + U64(depth))
        place[left[some]] = s.start[best]
        left = left[~some]
        if not len(left):
            break
    return name, place


def _spans(keys: np.ndarray, starts: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Keys, and the packed starts of each."""
    if not len(keys):
        return [], []
    order = np.lexsort((starts, keys))
    keys, starts = keys[order], starts[order].astype("<i8")
    cuts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    ends = [*cuts[1:].tolist(), len(keys)]
    return keys[cuts].tolist(), [starts[a:b].tobytes() for a, b in zip(cuts.tolist(), ends, strict=True)]


def repeated_windows(docs: DataFrame, length: int = WINDOW) -> DataFrame:
    """``_key``, ``starts`` (packed word numbers): windows that also start elsewhere.

    ``docs`` has ``_key`` (long) and ``text``; rows of one key have one text. A key
    may come in several rows.
    """
    shards = shards_for(docs)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "own", "tags", "places", "counts", "hashes"]
        kinds = [pa.int32(), *[pa.binary()] * 5]
        for batch in batches:
            for low, _, part in slices(batch.column(1)):
                starts, ends, first = part.words()
                at = window_starts(first, length)
                if not len(at):
                    continue
                words = span_hashes(part.data, starts, ends)
                hashes = window_hashes(words, length)[at]
                text = rows_of(first)[at]
                key = batch.column(0).slice(low, len(part)).to_numpy()[text]
                begin = at - first[text]
                order = np.argsort(hashes, kind="stable")
                same = hashes[order[1:]] == hashes[order[:-1]]
                again = np.zeros(len(at), bool)  # not the first of its like in this slice
                again[order[1:][same]] = True
                known = again.copy()
                known[order[:-1][same]] = True
                owners, packed = _spans(key[known], begin[known])
                yield pa.record_batch(
                    [
                        pa.array([k % shards for k in owners], pa.int32()),
                        pa.array([k.to_bytes(8, "little", signed=True) for k in owners], pa.binary()),
                        *(pa.nulls(len(owners), pa.binary()) for _ in range(3)),
                        pa.array(packed, pa.binary()),
                    ],
                    names,
                )
                name, place = anchors(parses(words, first), at, length)
                keep = np.flatnonzero(~again)
                shard = ((name >> U64(20)) % U64(shards)).astype(np.int64)
                keep = keep[np.argsort(shard[keep], kind="stable")]
                # Runs: windows of one occurrence of a symbol, one after the other.
                new = np.ones(len(keep), bool)
                new[1:] = (place[keep[1:]] != place[keep[:-1]]) | (keep[1:] != keep[:-1] + 1)
                new[1:] |= shard[keep[1:]] != shard[keep[:-1]]
                run = np.flatnonzero(new)
                count = np.diff(np.append(run, len(keep)))
                lead = keep[run]
                body = hashes[keep].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                cuts = np.flatnonzero(np.diff(shard[lead], prepend=-1)).tolist()
                rows = [[] for _ in names]
                for a, b in zip(cuts, [*cuts[1:], len(run)], strict=True):
                    own = lead[a:b]
                    rows[0].append(int(shard[own[0]]))
                    rows[1].append(key[own].astype("<i8").tobytes())
                    rows[2].append((name[own] & U64(0xFFFF)).astype("<u2").tobytes())
                    rows[3].append(begin[own].astype("<u4").tobytes())
                    rows[4].append(count[a:b].astype("<u2").tobytes())
                    rows[5].append(body[run[a] : run[a] + count[a:b].sum()].tobytes())
                yield pa.record_batch(
                    [pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names
                )

    def meet(table: pa.Table) -> pa.Table:
        keys, starts, values = [], [], []
        direct: list[tuple[int, bytes]] = []
        for own, tags, places, counts, hashes in zip(
            *(table.column(c).to_pylist() for c in ("own", "tags", "places", "counts", "hashes")), strict=True
        ):
            if tags is None:  # repeats found in one slice
                direct.append((int.from_bytes(own, "little", signed=True), hashes))
                continue
            count = np.frombuffer(counts, "<u2").astype(np.int64)
            total = int(count.sum())
            wide = np.zeros((total, 8), np.uint8)
            wide[:, :6] = np.frombuffer(hashes, np.uint8).reshape(-1, 6)
            tag = np.repeat(np.frombuffer(tags, "<u2").astype(U64), count)
            values.append(wide.view("<u8").reshape(-1) | (tag << U64(48)))
            begin = np.frombuffer(places, "<u4").astype(np.int64)
            inside = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
            starts.append(np.repeat(begin, count) + inside)
            keys.append(np.repeat(np.frombuffer(own, "<i8"), count))
        owners, packed = [k for k, _ in direct], [b for _, b in direct]
        if values:
            hit = repeated(np.concatenate(values))
            more, spans = _spans(np.concatenate(keys)[hit], np.concatenate(starts)[hit])
            owners, packed = owners + more, packed + spans
        return pa.table([pa.array(owners, pa.int64()), pa.array(packed, pa.binary())], ["_key", "starts"])

    return (
        docs.select("_key", "text")
        .mapInArrow(
            send, "shard int, own binary, tags binary, places binary, counts binary, hashes binary"
        )
        .repartition(shards, "shard")
        .groupBy("shard")
        .applyInArrow(meet, "_key long, starts binary")
    )


def drop_repeated_windows(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = WINDOW
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_text``, ``kept_sha256`` per row of ``docs``.

    A word goes if some window of ``length`` words that covers it also starts at
    another place of any row, judged on the texts as they came. Kept words are
    joined by one space. Null, empty and short texts lose nothing of their own
    (a text of fewer words has no window). A row that repeats loses all its
    windows, in every copy; null ids are ids like any other; other columns are
    ignored; an empty table gives an empty table.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")).withColumn(
        "_key", F.xxhash64("doc_id", "text")
    )
    found = repeated_windows(rows, length).groupBy("_key").agg(F.collect_list("starts").alias("_starts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts, starts = (batch.column(c) for c in ("doc_id", "text", "_starts"))
            for low, high, part in slices(texts):
                kept, totals, gone = [], [], []
                for row in range(len(part)):
                    words = part.text(row).split()  # bytes split at these six characters
                    spans = starts[low + row].as_py()
                    totals.append(len(words))
                    if spans:
                        steps = np.zeros(len(words) + 1, np.int64)
                        at = np.unique(np.frombuffer(b"".join(spans), "<i8"))
                        steps[at] += 1
                        steps[at + length] -= 1
                        stay = np.cumsum(steps[:-1]) == 0
                        words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                    gone.append(totals[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.record_batch(
                    [
                        names.slice(low, high - low),
                        pa.array(totals, pa.int64()),
                        pa.array(gone, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                        pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
                )

    return rows.join(found, "_key", "left").select("doc_id", "text", "_starts").mapInArrow(
        cut, f"doc_id {kind}, n_words long, n_removed long, kept_text string, kept_sha256 string"
    )
