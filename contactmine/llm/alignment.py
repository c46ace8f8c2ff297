"""Cross-tokenizer alignment with inverted bitmaps of token pairs.

Two tokenizers cut the same bytes; where tokens of both end at one place they are
linked. Each task encodes its texts with both and inverts them: for every pair of
ids the documents that hold it linked, as compressed bitmaps over blocks of the
task's own documents (16-bit places, sorted lists or plain bits, whichever is
smaller). Slices of a block are OR-merged before it is written. Plane 0 of a pair
says which documents hold it, so its bits are the document count; planes 1, 2, ...
are the binary digits of how many more times they do, so that the link count is
the sum of popcounts by weight. Counts of a pair are sums over blocks, the highest
of a B id a maximum over its pairs.

The scores go back through the postings: each bitmap meets its pair's score, and a
block's bitmaps add weight times score to the block's documents. A very frequent
pair has one bitmap a plane and block, so that it is no hot key; a block has a
bounded number of postings, whatever the lengths of texts (one text at least).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from contactmine.llm.pieces import PieceEncoder
from contactmine.llm.scratch import materialised
from contactmine.llm.textbytes import Texts, rows_of, slices

POSTINGS = 1 << 20  # of a block; it is closed beyond that
BLOCK_BITS = 16  # documents of a block at most: 2^16
_PLACES = 1 << BLOCK_BITS
_LIST = _PLACES // 16  # a longer list of 16-bit places is larger than the bits

DOCS = "doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
INDEX = "number long, block long, pair long, plane int, places binary"


def byte_level_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary, and its byte.

    Fixed format: visible Latin-1 characters stand for themselves, the other bytes,
    in order, for the characters from 256 on.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """A tokenizer's ids with the bytes of each."""

    _known: dict[tuple[str, str], Vocabulary] = {}

    def __init__(self, path: str, kind: str):
        self.encoder = PieceEncoder.of(path, kind)
        if kind == "piece":
            model = self.encoder.model
            pieces = map(model.id_to_piece, range(model.get_piece_size()))
            found = [
                bytes([int(p[1:-1], 16)]) if model.is_byte(k) else p.replace("▁", " ").encode()
                for k, p in enumerate(pieces)
            ]
        else:
            tokenizer, byte = self.encoder.tokenizer, byte_level_characters()
            tokens = map(tokenizer.id_to_token, range(tokenizer.get_vocab_size()))
            found = [bytes(map(byte.__getitem__, t)) if set(t) <= byte.keys() else t.encode() for t in tokens]
        self.bytes = pa.array(found, pa.large_binary())
        self.lengths = np.fromiter(map(len, found), np.int64, len(found))

    @classmethod
    def of(cls, path: str, kind: str) -> Vocabulary:
        if (path, kind) not in cls._known:
            cls._known[path, kind] = cls(path, kind)
        return cls._known[path, kind]

    def __len__(self) -> int:
        return len(self.lengths)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, one after the other."""
        return _body(self.bytes.take(pa.array(ids)))


def _body(strings: pa.Array) -> np.ndarray:
    body = strings.buffers()[2]
    return np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)


class Aligner:
    """Encodes texts with both tokenizers and groups their tokens."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Vocabulary.of(path_a, "plain"), Vocabulary.of(path_b, "piece")
        # Each id as it is written within a group and at its end: A ids, then B ids.
        written = [f"{k}{end}".encode() for k in range(len(self.a)) for end in ",|"]
        written += [f"{k}{end}".encode() for k in range(len(self.b)) for end in ",;"]
        self.written = pa.array(written, pa.large_binary())

    def _encode(self, part: Texts, keep: np.ndarray) -> tuple[Texts, tuple, tuple]:
        """Kept texts with a space before them, and ids and first id of each text by A and by B."""
        sizes = np.where(keep, np.diff(part.offsets), 0)
        stay = np.repeat(keep, np.diff(part.offsets))
        data = part.data[stay]
        at = (np.cumsum(sizes) - sizes)[keep]
        data = np.insert(data, at, 32)
        spaced = Texts(data, np.concatenate([[0], np.cumsum(sizes + keep)]))
        return spaced, self.a.encoder.encode(spaced), self.b.encoder.encode(spaced)

    def align(self, part: Texts) -> dict[str, np.ndarray | list[str]]:
        """Counts and group hash per text; ``pairs`` and ``first``: the linked pairs of each text."""
        keep = np.diff(part.offsets) > 0
        while True:
            texts, (ids_a, first_a), (ids_b, first_b) = self._encode(part, keep)
            bad = np.zeros(len(keep), bool)
            for side, ids, first in ((self.a, ids_a, first_a), (self.b, ids_b, first_b)):
                joined = side.joined(ids)
                if np.array_equal(joined, texts.data):
                    continue
                edge = np.concatenate([[0], np.cumsum(side.lengths[ids])])[first]
                for row in np.flatnonzero(keep).tolist():
                    own = joined[edge[row] : edge[row + 1]].tobytes()
                    bad[row] |= own != texts.text(row)
            if not bad.any():
                break
            keep = keep & ~bad  # a tokenizer changed the text: no tokens
        ends_a, ends_b = np.cumsum(self.a.lengths[ids_a]), np.cumsum(self.b.lengths[ids_b])
        place = np.searchsorted(ends_b, ends_a)
        last_a = ends_b[place] == ends_a if len(ends_b) else np.zeros(len(ends_a), bool)
        close_a, close_b = np.flatnonzero(last_a), place[last_a]
        last_b = np.zeros(len(ids_b), bool)
        last_b[close_b] = True
        # Where each token is written: the A tokens of a group, then its B tokens.
        group_a = np.cumsum(last_a) - last_a
        group_b = np.cumsum(last_b) - last_b
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        before_b = np.concatenate([[0], close_b + 1])
        order[np.arange(len(ids_a)) + before_b[group_a]] = 2 * ids_a.astype(np.int64) + last_a
        if len(ids_b):
            behind_a = close_a[group_b] + 1
            order[np.arange(len(ids_b)) + behind_a] = 2 * (len(self.a) + ids_b.astype(np.int64)) + last_b
        strings = self.written.take(pa.array(order))
        body = _body(strings).tobytes()
        edges = np.frombuffer(strings.buffers()[1], np.int64)[: len(order) + 1] if len(order) else np.zeros(1, np.int64)
        edges = edges[first_a + first_b].tolist()
        shas = [
            hashlib.sha256(body[low : high - 1]).hexdigest() if high > low else ""
            for low, high in zip(edges[:-1], edges[1:], strict=True)
        ]
        return {
            "n_a": np.diff(first_a),
            "n_b": np.diff(first_b),
            "sha": shas,
            "pairs": ids_a[close_a].astype(np.int64) * len(self.b) + ids_b[close_b],
            "first": np.searchsorted(close_a, first_a),
        }


def _bitmaps(pair: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Distinct pairs in order, and the compressed bitmap of the places of each.

    ``pair`` and ``place`` ordered by pair, then place: a list of 16-bit places, or
    2^16 bits where that is smaller.
    """
    cuts = np.flatnonzero(np.diff(pair, prepend=-1))
    ends = np.append(cuts, len(pair))[1:]
    body = place.astype("<u2").tobytes()
    out = [body[2 * a : 2 * b] for a, b in zip(cuts.tolist(), ends.tolist(), strict=True)]
    for k in np.flatnonzero(ends - cuts > _LIST).tolist():
        bits = np.zeros(_PLACES, bool)
        bits[place[cuts[k] : ends[k]]] = True
        out[k] = np.packbits(bits, bitorder="little").tobytes()
    return pair[cuts], out


def _unpacked(bitmap: bytes) -> np.ndarray:
    """The places of a compressed bitmap."""
    if len(bitmap) < _PLACES // 8:
        return np.frombuffer(bitmap, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little"))


def _popcounts(bitmaps: pa.Array) -> np.ndarray:
    """How many places each bitmap holds."""
    sizes = pc.binary_length(bitmaps).to_numpy()
    counts = sizes.astype(np.int64) // 2
    for k in np.flatnonzero(sizes == _PLACES // 8).tolist():
        counts[k] = int(np.bitwise_count(np.frombuffer(bitmaps[k].as_py(), np.uint64)).sum())
    return counts


class _Block:
    """Postings of a task's current block of documents."""

    def __init__(self) -> None:
        self.slices: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.docs = self.postings = 0

    def add(self, pairs: np.ndarray, first: np.ndarray) -> None:
        """The linked pairs of further documents."""
        row = rows_of(first)
        order = np.lexsort((row, pairs))
        pair, row = pairs[order], row[order]
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(pair)))
        self.slices.append((pair[at], self.docs + row[at], times))
        self.docs += len(first) - 1
        self.postings += len(at)

    def rows(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """``pair``, ``plane`` and bitmap of everything added: slices are OR-merged by pair."""
        pair, place, times = (np.concatenate(x) for x in zip(*self.slices, strict=True))
        order = np.lexsort((place, pair))
        pair, place, more = pair[order], place[order], times[order] - 1
        pairs, planes, bitmaps = [], [], []
        for plane in range(int(more.max(initial=0)).bit_length() + 1):
            own = np.flatnonzero((more >> (plane - 1)) & 1) if plane else np.arange(len(pair))
            names, found = _bitmaps(pair[own], place[own])
            pairs.append(names)
            planes.append(np.full(len(names), plane, np.int32))
            bitmaps += found
        return np.concatenate(pairs), np.concatenate(planes), bitmaps


def pair_index(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, id_column: str = "doc_id",
               text: str = "text") -> tuple[DataFrame, DataFrame, int]:
    """The texts' counts, the inverted bitmaps of token pairs, and the number of B ids.

    First table: ``number`` (block * 65536 + place) with the columns of ``DOCS``.
    Second: ``block``, ``pair`` (A id times number of B ids, plus B id), ``plane`` and ``places``.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"{INDEX}, {DOCS.format(kind=kind)}"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(tokenizer_a, tokenizer_b)
        number = TaskContext.get().partitionId() << 24  # this task's blocks
        block = _Block()

        def batch_of(rows: int, **columns: pa.Array) -> pa.RecordBatch:
            return pa.record_batch([columns.get(n, pa.nulls(rows, t)) for n, t in types], names)

        def index(block: _Block) -> Iterator[pa.RecordBatch]:
            if not block.postings:
                return
            pair, plane, places = block.rows()
            for low in range(0, len(pair), 1 << 16):
                at = slice(low, low + (1 << 16))
                rows = len(pair[at])
                yield batch_of(
                    rows, block=pa.array(np.full(rows, number)), pair=pa.array(pair[at]),
                    plane=pa.array(plane[at]), places=pa.array(places[at], pa.binary()),
                )

        types: list[tuple[str, pa.DataType]] = []
        for batch in batches:
            if not types:
                plain = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                plain += [batch.column(0).type, *[pa.int64()] * 4, pa.string()]
                types = list(zip(names, plain, strict=True))
            for low, high, part in slices(batch.column(1), most_rows=_PLACES // 2):
                rows = high - low
                if block.docs + rows > _PLACES or block.postings >= POSTINGS:
                    yield from index(block)
                    block, number = _Block(), number + 1
                found = aligner.align(part)
                links = pa.array(np.diff(found["first"]))
                yield batch_of(
                    rows, number=pa.array((number << BLOCK_BITS) + block.docs + np.arange(rows)),
                    doc_id=batch.column(0).slice(low, rows), n_a=pa.array(found["n_a"]), n_b=pa.array(found["n_b"]),
                    n_groups=links, n_links=links, groups_sha256=pa.array(found["sha"], pa.string()),
                )
                block.add(found["pairs"], found["first"])
        yield from index(block)

    table = materialised(docs.select(F.col(id_column).alias("doc_id"), F.col(text)).mapInArrow(run, schema))
    plain = [c.split()[0] for c in DOCS.split(", ")]
    width = len(Vocabulary.of(tokenizer_b, "piece"))
    return (
        table.where("pair IS NULL").select("number", *plain),
        table.where("pair IS NOT NULL").select("block", "pair", "plane", "places"),
        width,
    )


def pair_counts(index: DataFrame, width: int) -> DataFrame:
    """``pair``, ``a``, ``b``, ``n_docs``, ``n_links`` of every linked pair, and ``best``.

    ``best``: no other A id is linked more often with this B id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plane = batch.column(1).to_numpy().astype(np.int64)
            bits = _popcounts(batch.column(2))
            links = np.where(plane > 0, bits << np.maximum(plane - 1, 0), bits)
            columns = [batch.column(0), pa.array(np.where(plane == 0, bits, 0)), pa.array(links)]
            yield pa.record_batch(columns, ["pair", "n_docs", "n_links"])

    counts = (
        index.select("pair", "plane", "places")
        .mapInArrow(run, "pair long, n_docs long, n_links long")
        .groupBy("pair")
        .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
        .select("pair", F.expr(f"pair div {width}").alias("a"), F.expr(f"pair % {width}").alias("b"), "n_docs", "n_links")
    )
    counts = materialised(counts)
    highest = counts.groupBy("b").agg(F.max("n_links").alias("most"))
    return counts.join(highest, "b").select(*counts.columns, (F.col("n_links") == F.col("most")).alias("best"))


def link_scores(index: DataFrame, counts: DataFrame) -> DataFrame:
    """``number``, ``count_sum``, ``n_best``: scores of the pairs, through the postings to the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros((2, _PLACES), np.int64)

        def close() -> pa.RecordBatch:
            some = np.flatnonzero(sums[0])
            columns = [(now << BLOCK_BITS) + some, sums[0][some], sums[1][some]]
            sums[:] = 0
            return pa.record_batch([pa.array(c) for c in columns], ["number", "count_sum", "n_best"])

        for batch in batches:
            blocks = batch.column(0).to_numpy()
            plane = batch.column(1).to_numpy().astype(np.int64)
            weight = np.int64(1) << np.maximum(plane - 1, 0)
            score = weight * batch.column(3).to_numpy()
            best = weight * np.array(batch.column(4).to_pylist(), np.int64)
            cuts = np.flatnonzero(np.diff(blocks, prepend=-1)).tolist()
            for low, high in zip(cuts, [*cuts, len(blocks)][1:], strict=True):
                if now is not None and now != blocks[low]:
                    yield close()
                now = int(blocks[low])
                found = [_unpacked(b) for b in batch.column(2).slice(low, high - low).to_pylist()]
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                places = np.concatenate(found)
                # Sums of whole numbers; add.at keeps them exact beyond 2^53.
                np.add.at(sums[0], places, np.repeat(score[low:high], sizes))
                np.add.at(sums[1], places, np.repeat(best[low:high], sizes))
        if now is not None:
            yield close()

    scored = index.join(counts.select("pair", "n_links", "best"), "pair")
    return (
        scored.select("block", "plane", "places", "n_links", "best")
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(run, "number long, count_sum long, n_best long")
    )


def align_tokenizers(
    docs: DataFrame, tokenizer_a: str, tokenizer_b: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    One row per row of ``docs``. ``tokenizer_a`` is the path of a byte-level BPE
    file, ``tokenizer_b`` of a sentencepiece model that puts a space before a text
    and has no piece with a space behind another character. Both encode a space
    and the text, special strings as plain text. Offsets where tokens of both end
    cut the tokens into groups; an A and a B token that end together are a link; a
    pair's count is how many links of the whole table hold it. ``n_best``: links
    whose count is their B id's highest; ``count_sum``: counts over links;
    ``groups_sha256``: of the groups' ids. Null and empty texts, and texts that a
    tokenizer does not give back byte by byte, have no tokens: zeros and ''.
    Repeated rows and null ids are documents of their own; other columns are
    ignored; an empty table gives an empty table.
    """
    texts, index, width = pair_index(docs, tokenizer_a, tokenizer_b, id_column, text)
    scores = link_scores(index, pair_counts(index, width))
    return texts.join(scores, "number", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
        "groups_sha256",
    )
