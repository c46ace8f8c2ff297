"""Bounded-space online packing of token ids into windows.

Each task keeps a fixed number of open windows. A document's ids come in order:
whole windows are cut off the front, the rest goes into the open window it fits
best. When none fits, the fullest window is topped up with the head of the rest
and emitted, so every emitted window is full. At the end of a task its open
windows are poured together, which leaves at most one window that is not full;
these leftovers of all tasks are merged last, without cutting.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from contactmine.llm.pieces import PieceEncoder
from contactmine.llm.scratch import materialised
from contactmine.llm.textbytes import slices

PIECE = (
    "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
# Tasks whose leftovers meet in one merge group: at most so many part windows.
MERGED = 512


class Packer:
    """Open windows as lists of (document, start, length), sorted by free room.

    ``place`` returns the windows that became full, each a list of pieces.
    """

    def __init__(self, size: int, windows: int):
        self.size, self.most = size, windows
        self.free: list[int] = []  # free room, ascending; the window in the same place
        self.open: list[list[tuple]] = []

    def _put(self, room: int, window: list) -> None:
        at = bisect.bisect_left(self.free, room)
        self.free.insert(at, room)
        self.open.insert(at, window)

    def place(self, doc: int, tokens: int) -> list[list[tuple]]:
        full, start = [], 0
        while tokens - start >= self.size:
            full.append([(doc, start, self.size)])
            start += self.size
        rest = tokens - start
        while rest:
            at = bisect.bisect_left(self.free, rest)  # the tightest room that holds it
            if at < len(self.free):
                room, window = self.free.pop(at), self.open.pop(at)
            elif len(self.free) < self.most:
                room, window = self.size, []
            else:  # none fits: top up the fullest and emit it
                room, window = self.free.pop(0), self.open.pop(0)
            put = min(room, rest)
            window.append((doc, start, put))
            start, rest = start + put, rest - put
            if room == put:
                full.append(window)
            else:
                self._put(room - put, window)
        return full

    def pour(self) -> tuple[list[list[tuple]], list[tuple]]:
        """Empty the open windows into full ones; the last may not be full."""
        full, now, room = [], [], self.size
        for window in self.open:  # the fullest first
            for doc, start, length in window:
                while length:
                    put = min(room, length)
                    now.append((doc, start, put))
                    start, length, room = start + put, length - put, room - put
                    if not room:
                        full.append(now)
                        now, room = [], self.size
        self.free, self.open = [], []
        return full, now


def _best_fit(table: pa.Table, size: int) -> pa.Table:
    """Whole part windows of many tasks, best fit decreasing into new windows."""
    frame = table.to_pandas(types_mapper=pd.ArrowDtype)
    loads = frame.groupby("sequence_id")["length"].sum()
    loads = sorted(((int(n), int(s)) for s, n in loads.items()), key=lambda x: (-x[0], x[1]))
    free: list[tuple[int, int]] = []  # (room, first sequence id)
    moved: dict[int, tuple[int, int]] = {}
    for load, name in loads:
        at = bisect.bisect_left(free, (load, -1))
        room, head = free.pop(at) if at < len(free) else (size, name)
        moved[name] = (head, size - room)
        bisect.insort(free, (room - load, head))
    heads = frame["sequence_id"].map(lambda s: moved[s][0])
    shift = frame["sequence_id"].map(lambda s: moved[s][1])
    frame["offset"] = (frame["offset"].astype("int64") + shift.astype("int64")).astype("int64")
    frame["sequence_id"] = heads.astype("int64")
    return pa.Table.from_pandas(frame.drop(columns=["part"]), preserve_index=False)


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text: str = "text",
    size: int = 4096,
    windows: int = 64,
    end_id: int = 2,
) -> DataFrame:
    """One row per piece: where ``length`` ids of a document lie in a sequence.

    ``doc_id``, ``start`` (ids of the document before the piece), ``length``,
    ``ids_crc32`` (of the little-endian 32-bit ids), ``doc_tokens`` (with the end
    id), ``sequence_id``, ``offset``. ``tokenizer`` is the path of a BPE file that
    drops white space. Null text is empty: the end id alone. Repeated rows and
    null ids are documents of their own; other columns are ignored; an empty
    table gives an empty table.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    columns = [c.split()[0] for c in PIECE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.of(tokenizer, "word")
        packer = Packer(size, windows)
        part = TaskContext.get().partitionId()
        sequence = part << 32
        # Of documents with pieces in open windows: id, tokens, ids from the first such piece on.
        held: dict[int, tuple] = {}
        number = 0

        def rows(full: list[list[tuple]], closed: bool) -> pa.RecordBatch:
            nonlocal sequence
            out: list[list] = [[] for _ in columns]
            for window in full:
                offset = 0
                for doc, start, length in window:
                    name, tokens, ids, gone = held[doc]
                    crc = zlib.crc32(ids[start - gone : start - gone + length].tobytes())
                    values = (name, start, length, crc, tokens, sequence, offset)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                    offset += length
                sequence += 1
            arrays = [pa.array(out[0], id_type), *(pa.array(c, pa.int64()) for c in out[1:])]
            size_of = len(out[0])
            return pa.record_batch(
                [*arrays, pa.array([part] * size_of, pa.int64()), pa.array([closed] * size_of, pa.bool_())],
                [*columns, "part", "closed"],
            )

        id_type = pa.null()
        for batch in batches:
            id_type = batch.column(0).type
            names = batch.column(0).to_pylist()
            for low, _, texts in slices(batch.column(1)):
                ids, first = encoder.encode(texts)
                full = []
                for row in range(len(texts)):
                    own = np.append(ids[first[row] : first[row + 1]], end_id).astype("<u4")
                    held[number] = (names[low + row], len(own), own, 0)
                    full += packer.place(number, len(own))
                    number += 1
                yield rows(full, True)
                # Keep ids only of what still lies in open windows.
                needed: dict[int, int] = {}
                for window in packer.open:
                    for doc, start, _ in window:
                        needed[doc] = min(start, needed.get(doc, start))
                held = {
                    doc: (*held[doc][:2], held[doc][2][start - held[doc][3] :].copy(), start)
                    for doc, start in needed.items()
                }
        full, last = packer.pour()
        yield rows(full, True)
        if last:
            yield rows([last], False)

    schema = PIECE.format(kind=kind)
    pieces = materialised(
        docs.select(F.col(id_column).alias("doc_id"), F.col(text)).mapInArrow(
            run, f"{schema}, part long, closed boolean"
        )
    )
    merged = (
        pieces.where(~F.col("closed"))
        .drop("closed")
        .withColumn("part", F.expr(f"part div {MERGED}"))
        .groupBy("part")
        .applyInArrow(lambda table: _best_fit(table, size), schema)
    )
    return pieces.where("closed").select(*columns).unionByName(merged)
