"""Token ids of whole texts, each distinct piece encoded once per Python worker.

A text is cut only where the tokenizer's own rules always cut, so the ids of the
pieces, put together, are the ids of the text. Pieces repeat like words do; their
ids are remembered in sorted arrays by the piece's hash, and reused after the
piece's bytes have been compared. New pieces are encoded in batches of equal
bytes. The memory is bounded and starts anew when full.
"""

from __future__ import annotations

import os

import numpy as np
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from contactmine.llm.textbytes import LOWER, SPACE, U64, Texts, same_spans, span_hashes

MOST_PIECES = 1 << 20  # less than 100 MB
BATCH_BYTES = 1 << 16

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN = np.zeros(256, bool)  # signs that no contraction or special string begins with
_SIGN[[*b'.,;:!?()"']] = True
_GRAPH = np.zeros(256, bool)
_GRAPH[33:127] = True


def _neighbours(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte before each place and the one before that (0 at the start)."""
    padded = np.concatenate([np.zeros(2, np.uint8), data])
    return padded[1:-1], padded[:-2]


def byte_level_cuts(data: np.ndarray) -> np.ndarray:
    """Where a byte-level pre-tokenizer cuts for certain.

    Before a space or line break after a visible character (ASCII or Latin-1
    letter), after a line break between two visible ASCII characters, and
    between an ASCII letter and a full stop or the like.
    """
    one, two = _neighbours(data)
    seen = _GRAPH[one] | ((two == 0xC3) & (one >= 0x80))
    cut = seen & ((data == 32) | (data == 10))
    cut |= (one == 10) & _GRAPH[two] & _GRAPH[data]
    cut |= _LETTER[one] & _SIGN[data]
    return cut


def word_level_cuts(data: np.ndarray) -> np.ndarray:
    """Where a pre-tokenizer that drops white space cuts for certain.

    At white space, and between an ASCII letter and a full stop or the like.
    """
    one, _ = _neighbours(data)
    return SPACE[data] | SPACE[one] | (_LETTER[one] & _SIGN[data])


def piece_level_cuts(data: np.ndarray) -> np.ndarray:
    """Where a tokenizer cuts none of whose pieces has a space after another character: before such spaces."""
    one, _ = _neighbours(data)
    return (data == 32) & (one != 32)


class PieceEncoder:
    """Ids of pieces by hash; one per tokenizer file, way of cutting and worker.

    ``kind``: "byte" (byte-level), "word" (white space is dropped and A-Z are
    lower-cased by the tokenizer), "plain" (byte-level, special strings are plain
    text) or "piece" (a sentencepiece model that begins a text with a space: texts
    given here bring that space along).
    """

    _known: dict[tuple[str, str], PieceEncoder] = {}

    def __init__(self, path: str, kind: str):
        self.kind = kind
        if kind == "piece":
            self.model = SentencePieceProcessor(model_file=path)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
            self.tokenizer.encode_special_tokens = kind == "plain"
        self._forget()

    @classmethod
    def of(cls, path: str, kind: str) -> PieceEncoder:
        if (path, kind) not in cls._known:
            cls._known[path, kind] = cls(path, kind)
        return cls._known[path, kind]

    def _forget(self) -> None:
        self.hashes = np.zeros(0, U64)  # sorted
        self.slots = np.zeros(0, np.int32)  # the slot of each
        self.count = 0
        self.first = np.zeros(1 << 12, np.int64)  # of each slot: its first id (and the end)
        self.edges = np.zeros(1 << 12, np.int64)  # and its first byte (and the end)
        self.ids = np.zeros(1 << 14, np.int32)
        self.body = np.zeros(1 << 14, np.uint8)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        if self.kind == "piece":
            found = self.model.encode([t[1:] for t in texts], num_threads=1)
            space = self.model.piece_to_id("\u2581")
            return [ids if len(t) > 1 else [space] for t, ids in zip(texts, found, strict=True)]
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and how many each has; in batches of about the same bytes."""
        body = data.tobytes()
        ids, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        edge = np.concatenate([[0], np.cumsum(ends - starts)])
        low = 0
        while low < len(starts):
            high = max(int(np.searchsorted(edge, edge[low] + BATCH_BYTES, side="right")) - 1, low + 1)
            spans = zip(starts[low:high].tolist(), ends[low:high].tolist(), strict=True)
            found = self._encode([body[a:b].decode("utf-8", "replace") for a, b in spans])
            lengths.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter((i for f in found for i in f), np.int32, int(lengths[-1].sum())))
            low = high
        return np.concatenate(ids), np.concatenate(lengths)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """New slots for these pieces."""
        ids, lengths = self._ids(data, starts, ends)
        sizes = ends - starts
        base = np.concatenate([[0], np.cumsum(sizes)])
        own = data[np.arange(base[-1]) + np.repeat(starts - base[:-1], sizes)]
        low, high = self.count, self.count + len(starts)
        for name, values, edge in (("ids", ids, "first"), ("body", own, "edges")):
            counts = lengths if edge == "first" else sizes
            at = int(getattr(self, edge)[low])
            setattr(self, name, _room(getattr(self, name), at + len(values)))
            setattr(self, edge, _room(getattr(self, edge), high + 1))
            getattr(self, name)[at : at + len(values)] = values
            getattr(self, edge)[low + 1 : high + 1] = at + np.cumsum(counts)
        self.count = high
        return np.arange(low, high, dtype=np.int32)

    def _found(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        """The slot of every piece; None where two different pieces share a hash."""
        distinct, at, inverse = np.unique(
            span_hashes(data, starts, ends), return_index=True, return_inverse=True
        )
        heads, tails = starts[at], ends[at]
        if not same_spans(data, starts, ends, data, heads[inverse], tails[inverse]):
            return None
        place = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inner = place < len(self.hashes)
        known[inner] = self.hashes[place[inner]] == distinct[inner]
        if self.count + int((~known).sum()) > MOST_PIECES:
            self._forget()
            known[:], place[:] = False, 0
        slots = np.empty(len(distinct), np.int32)
        slots[known] = self.slots[place[known]]
        old = slots[known]
        if not same_spans(data, heads[known], tails[known], self.body, self.edges[old], self.edges[old + 1]):
            return None
        new = ~known
        if new.any():
            slots[new] = self._learn(data, heads[new], tails[new])
            self.hashes = np.insert(self.hashes, place[new], distinct[new])
            self.slots = np.insert(self.slots, place[new], slots[new])
        return slots[inverse]

    def encode(self, part: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and where each text's ids start (and the end)."""
        lengths, first, places, ids = self._spread(part)
        sums = np.concatenate([[0], np.cumsum(lengths)])
        return ids[np.arange(sums[-1]) + np.repeat(places - sums[:-1], lengths)], sums[first]

    def counts(self, part: Texts) -> np.ndarray:
        """Tokens of each text."""
        lengths, first, *_ = self._spread(part)
        sums = np.concatenate([[0], np.cumsum(lengths)])
        return sums[first[1:]] - sums[first[:-1]]

    def _spread(self, part: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """How many ids each piece has, the first piece of each text (and the end), where its ids start in which array."""
        data, words = part.data, self.kind == "word"
        cut = {"word": word_level_cuts, "piece": piece_level_cuts}.get(self.kind, byte_level_cuts)(data)
        cut[part.offsets[part.offsets < len(data)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))[: len(starts)]
        if words:
            dark = ~SPACE[data[starts]]
            starts, ends = starts[dark], ends[dark]
            if b"<|" not in data.tobytes():  # case matters in special strings
                data = LOWER[data]
        first = np.searchsorted(starts, part.offsets)
        slots = self._found(data, starts, ends)
        if slots is None:
            ids, lengths = self._ids(data, starts, ends)
            return lengths, first, np.cumsum(lengths) - lengths, ids
        places = self.first[slots]
        return self.first[slots + 1] - places, first, places, self.ids


def _room(values: np.ndarray, size: int) -> np.ndarray:
    while len(values) < size:
        values = np.concatenate([values, np.zeros_like(values)])
    return values
