"""Numpy over the bytes of a text column: words, lines and their hashes.

White space is always the six ASCII characters ``[\\x20\\x09-\\x0D]``; its bytes
never occur inside a longer UTF-8 character, so bytes can be cut there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    x = np.asarray(x, U64).copy()
    with np.errstate(over="ignore"):
        x += U64(0x9E3779B97F4A7C15)
        x ^= x >> U64(30)
        x *= U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
    return x


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z as a-z

_RUN = 1 << 17  # pieces of eight bytes that are hashed at once
_FRONT = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)  # the first n of eight bytes
_PLACE = U64(0x9FB21C651E98DF25)
_LENGTH = U64(0xA24BAED4963EE407)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number, zeros after the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def _runs(lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Spans ``[low, high)`` of some eights each, the first eight of each span (and the end),
    the span of every eight and its number there. An empty span has one eight.
    """
    edge = np.concatenate([[0], np.cumsum(np.maximum((lengths + 7) >> 3, 1))])
    low = 0
    while low < len(lengths):
        high = int(np.searchsorted(edge, edge[low] + _RUN, side="right")) - 1
        high = min(max(high, low + 1), len(lengths))
        first = edge[low : high + 1] - edge[low]
        own = np.repeat(np.arange(high - low), np.diff(first))
        yield low, high, first, own, np.arange(first[-1]) - first[own]
        low = high


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes ``data[start:end]`` for each span, in linear time.

    Every eight bytes are mixed with their place in the span, so that the sum
    depends on the order in no linear way; equal spans have equal hashes wherever
    they stand. Memory beyond the result is bounded but for a single long span.
    """
    wide, lengths = _eights(data), ends - starts
    out = np.empty(len(starts), U64)
    for low, high, first, own, inside in _runs(lengths):
        left = np.clip(lengths[low:high][own] - 8 * inside, 0, 8)
        eight = wide[starts[low:high][own] + 8 * inside] & _FRONT[left]
        mixed = mix(eight ^ mix(inside.astype(U64) * _PLACE))
        out[low:high] = np.add.reduceat(mixed, first[:-1])
    return mix(out + lengths.astype(U64) * _LENGTH)


def same_spans(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
    other: np.ndarray, others: np.ndarray, other_ends: np.ndarray,
) -> bool:
    """Whether each span of ``data`` holds the same bytes as its partner in ``other``."""
    lengths = ends - starts
    if not np.array_equal(lengths, other_ends - others):
        return False
    one, two = _eights(data), _eights(other)
    for low, high, _, own, inside in _runs(lengths):
        front = _FRONT[np.clip(lengths[low:high][own] - 8 * inside, 0, 8)]
        a = one[starts[low:high][own] + 8 * inside] & front
        if (a != two[others[low:high][own] + 8 * inside] & front).any():
            return False
    return True


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a + _LENGTH) * _PLACE + b)


def window_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` consecutive values, by doubling: one per place where they fit."""
    count = len(values) - length + 1
    if count <= 0:
        return np.zeros(0, U64)
    out, done, power, width = None, 0, values, 1
    while True:
        if length & width:
            part = power[done : done + count]
            out = part if out is None else _joined(out, part)
            done += width
        if done == length:
            return mix(out + U64(length))
        power = _joined(power[:-width], power[width:])
        width *= 2


class Texts:
    """Some rows of a text column: ``data`` bytes, ``offsets`` of the texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and the first word of each text (and the end)."""
        dark = ~SPACE[self.data]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.offsets] = True
        before = np.empty(len(dark), bool)
        before[:1] = True
        before[1:] = ~dark[:-1]
        after = np.empty(len(dark), bool)
        after[-1:] = True
        after[:-1] = ~dark[1:]
        starts = np.flatnonzero(dark & (before | edge[:-1]))
        ends = np.flatnonzero(dark & (after | edge[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all \\n-split lines, and the first line of each text (and the end)."""
        breaks = np.flatnonzero(self.data == 10)
        starts = np.concatenate([self.offsets[:-1], breaks + 1])
        ends = np.concatenate([breaks, self.offsets[1:]])
        row = np.searchsorted(self.offsets[1:], breaks, side="right")
        rows = np.arange(len(self))
        order = np.lexsort((starts, np.concatenate([rows, row])))
        starts = starts[order]
        ends = ends[np.lexsort((ends, np.concatenate([row, rows])))]
        counts = np.bincount(row, minlength=len(self)) + 1
        return starts, ends, np.concatenate([[0], np.cumsum(counts)])


def slices(
    column: pa.Array, most: int = SLICE_BYTES, most_rows: int = 1 << 16
) -> Iterator[tuple[int, int, Texts]]:
    """Rows ``[low, high)`` of at most so many bytes (one text at least); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1
        high = min(max(high, low + 1), low + most_rows, len(column))
        first = offsets[low]
        yield low, high, Texts(data[first : offsets[high]], offsets[low : high + 1] - first)
        low = high
    # What earlier batches took goes back to the system: workers outlive tasks.
    pa.default_memory_pool().release_unused()


def rows_of(first: np.ndarray) -> np.ndarray:
    """The text each word belongs to, from the first word of each text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def covered(starts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which of ``total`` places lie in some ``[start, start + length)``."""
    steps = np.zeros(total + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + length, -1)
    return np.cumsum(steps[:-1]) > 0


def window_starts(first: np.ndarray, length: int) -> np.ndarray:
    """Places where a window of so many words fits into its text."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    base = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    return base + np.arange(counts.sum())


def shingles(part: Texts, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles, A-Z lower-cased, and the first of each text (and the end).

    A text of fewer words is one shingle; a text without words has none.
    """
    starts, ends, first = part.words()
    words = span_hashes(LOWER[part.data], starts, ends)
    counts = np.diff(first)
    many = np.where(counts >= length, counts - length + 1, np.minimum(counts, 1))
    base = np.concatenate([[0], np.cumsum(many)])
    out = np.empty(base[-1], U64)
    out[np.repeat(counts >= length, many)] = window_hashes(words, length)[window_starts(first, length)]
    few = np.flatnonzero((counts > 0) & (counts < length))
    whole = counts[few].astype(U64)
    for k in range(length - 1):
        more = counts[few] > k
        whole[more] = _joined(whole[more], words[first[few[more]] + k])
    out[base[few]] = whole
    return out, base


def distinct_sets(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct hashes in ascending order, and the first of each text (and the end)."""
    own = [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    sizes = np.fromiter(map(len, own), np.int64, len(own))
    return (np.concatenate(own) if own else hashes), np.concatenate([[0], np.cumsum(sizes)])
