"""Line dedup with a sharded minimal perfect hash.

Every distinct line key gets a 128-bit hash. The hashes are dealt into shards by
a remainder; each shard is a minimal perfect hash over its keys (levels
of bit arrays: a key settles on the first level where nobody else wants its
bit) that indexes two flat arrays, a fingerprint and a document count per key.
Documents then probe the arrays with their line hashes; no line text is joined
or shuffled.

Lines in very many documents would send a third of all probes to one shard.
There are at most ``HOT_PARTS`` keys with more than that share of all
occurrences, so these form a shard of their own that travels with the job;
the other probes are spread evenly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from contactmine.llm.scratch import materialised, unused
from contactmine.llm.textbytes import SPACE, mix, slices

SHARD_KEYS = 1 << 16
HOT_PARTS = 10_000
RESULTS = ("_kept", "_n_lines", "_n_dropped", "_kept_sha256")
_BLANK = bytes(np.flatnonzero(SPACE).tolist())
_LEVELS = 24


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys; unknown keys get any index."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest  # bits (bool) by level; what never settled
        self.ranks = [np.cumsum(bits, dtype=np.int64) for bits in levels]
        totals = [int(rank[-1]) for rank in self.ranks]
        self.bases = np.concatenate([[0], np.cumsum(totals)]).astype(np.int64)

    @staticmethod
    def _bit(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys ^ np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(keys) and len(levels) < _LEVELS:
            size = max(8, 2 * len(keys))
            bit = cls._bit(keys, len(levels), size)
            alone = np.bincount(bit, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[bit]]
        return cls(levels, np.sort(keys))

    def index(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        left = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            bit = self._bit(keys[left], level, len(bits))
            found = bits[bit]
            out[left[found]] = self.bases[level] + self.ranks[level][bit[found]] - 1
            left = left[~found]
        if len(self.rest):
            out[left] = self.bases[-1] + np.minimum(
                np.searchsorted(self.rest, keys[left]), len(self.rest) - 1
            )
        return out

    def pack(self) -> list[bytes]:
        sizes = np.array([len(b) for b in self.levels], np.int64)
        return [
            sizes.tobytes(),
            b"".join(np.packbits(b).tobytes() for b in self.levels),
            self.rest.tobytes(),
        ]

    @classmethod
    def unpack(cls, sizes: bytes, bits: bytes, rest: bytes) -> PerfectHash:
        levels, at = [], 0
        for size in np.frombuffer(sizes, np.int64).tolist():
            width = (size + 7) // 8
            part = np.frombuffer(bits, np.uint8, width, at)
            levels.append(np.unpackbits(part, count=size).astype(bool))
            at += width
        return cls(levels, np.frombuffer(rest, np.uint64))


class Shard:
    """The arrays of one shard: fingerprint and document count by perfect hash."""

    def __init__(self, hashes: PerfectHash, prints: np.ndarray, counts: np.ndarray):
        self.hashes, self.prints, self.counts = hashes, prints, counts

    @classmethod
    def build(cls, keys: np.ndarray, prints: np.ndarray, counts: np.ndarray) -> Shard:
        hashes = PerfectHash.build(keys)
        at = hashes.index(keys)
        by_index = np.empty(len(keys), np.int64)
        by_index[at] = np.arange(len(keys))
        return cls(hashes, prints[by_index], counts[by_index])

    def count(self, keys: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Documents that hold each key, 0 for keys not in the shard."""
        if not len(self.counts):
            return np.zeros(len(keys), np.int64)
        at = self.hashes.index(keys)
        return np.where(self.prints[at] == prints, self.counts[at], 0)

    def pack(self) -> list[bytes]:
        return [*self.hashes.pack(), self.prints.tobytes(), self.counts.tobytes()]

    @classmethod
    def unpack(cls, sizes: bytes, bits: bytes, rest: bytes, prints: bytes, counts: bytes) -> Shard:
        return cls(
            PerfectHash.unpack(sizes, bits, rest),
            np.frombuffer(prints, np.uint64),
            np.frombuffer(counts, np.int64),
        )


_SHARD = "sizes binary, bits binary, rest binary, prints binary, counts binary"


def _line_keys(text: bytes) -> list[bytes]:
    # bytes.lower() changes A-Z only
    return [line.strip(_BLANK) for line in text.lower().split(b"\n")]


def _hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    digests = b"".join(map(xxhash.xxh3_128_digest, keys))
    pairs = np.frombuffer(digests, np.uint64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _digests(h1: np.ndarray, h2: np.ndarray) -> pa.Array:
    body = pa.py_buffer(np.stack([h1, h2], 1).tobytes())
    return pa.Array.from_buffers(pa.binary(16), len(h1), [None, body]).cast(pa.binary())


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def line_counts(docs: DataFrame, text: str = "text", min_chars: int = 1) -> DataFrame:
    """``h1``, ``h2``, ``n``: each distinct line key's hash and its number of documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, part in slices(batch.column(0)):
                keys: list[bytes] = []
                for row in range(len(part)):
                    keys += {k for k in _line_keys(part.text(row)) if _long_enough(k, min_chars)}
                h1, h2 = _hashes(keys)
                pairs = np.stack([h1, h2], 1)
                found, counts = np.unique(pairs, axis=0, return_counts=True)
                yield pa.record_batch(
                    [
                        pa.array(found[:, 0].view(np.int64)),
                        pa.array(found[:, 1].view(np.int64)),
                        pa.array(counts.astype(np.int64)),
                    ],
                    ["h1", "h2", "n"],
                )

    each = docs.select(text).mapInArrow(count, "h1 long, h2 long, n long")
    return each.groupBy("h1", "h2").agg(F.sum("n").alias("n"))


def build_shards(counts: DataFrame, shards: int) -> DataFrame:
    """One row of arrays per shard: ``shard`` and the packed perfect hash."""

    def build(table: pa.Table) -> pa.Table:
        h1, h2, n = (table.column(c).to_numpy() for c in ("h1", "h2", "n"))
        packed = Shard.build(h1.view(np.uint64), h2.view(np.uint64), n).pack()
        return pa.table([table.column("shard").slice(0, 1), *([x] for x in packed)],
                        ["shard", "sizes", "bits", "rest", "prints", "counts"])

    return (
        counts.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInArrow(build, f"shard int, {_SHARD}")
    )


def common_lines(
    docs: DataFrame,
    key: str,
    text: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
) -> tuple[DataFrame, Shard]:
    """The lines found in ``min_docs`` documents or more.

    Returns ``_id``, ``_hits`` (packed hashes of such lines, per value of the column
    ``key`` that has any) and the shard of the most frequent lines, which are not in
    ``_hits``.
    """
    counts = materialised(line_counts(docs, text, min_chars))
    keys, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards = keys // SHARD_KEYS + 1
    # Fewer than HOT_PARTS keys can have more than 1 / HOT_PARTS of all occurrences.
    frequent = counts.where(F.col("n") > max(min_docs - 1, total // HOT_PARTS)).toArrow()
    h1, h2, n = (frequent.column(c).to_numpy() for c in ("h1", "h2", "n"))
    hot = Shard.build(h1.view(np.uint64), h2.view(np.uint64), n)
    packed_hot = hot.pack()

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = Shard.unpack(*packed_hot)
        for batch in batches:
            for low, _, part in slices(batch.column(1)):
                keys: list[bytes] = []
                owners: list[int] = []
                for row in range(len(part)):
                    own = {k for k in _line_keys(part.text(row)) if _long_enough(k, min_chars)}
                    keys += own
                    owners += [low + row] * len(own)
                a, b = _hashes(keys)
                rest = often.count(a, b) == 0
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(np.array(owners, np.int64)[rest])),
                        pa.array((a[rest].view(np.int64) % shards).astype(np.int32)),
                        pa.array(a[rest].view(np.int64)),
                        pa.array(b[rest].view(np.int64)),
                    ],
                    ["_id", "shard", "h1", "h2"],
                )

    kind = docs.schema[key].dataType.simpleString()
    probes = docs.select(F.col(key).alias("_id"), text).mapInArrow(
        probe, f"_id {kind}, shard int, h1 long, h2 long"
    )
    arrays = materialised(build_shards(counts, shards))
    # A shard's arrays come first in its run of rows, then the probes, in batches.
    together = arrays.select(
        F.lit(None).cast(kind).alias("_id"), "shard", F.lit(None).cast("long").alias("h1"),
        F.lit(None).cast("long").alias("h2"), F.lit(0).alias("kind"), F.struct("sizes", "bits", "rest", "prints", "counts").alias("arrays"),
    ).unionByName(probes.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, shard = -1, None
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            cuts = np.flatnonzero(np.diff(numbers, prepend=-1))
            for start, end in zip(cuts, [*cuts[1:], len(numbers)], strict=True):
                run = batch.slice(start, end - start)
                if numbers[start] != name:  # its first row holds the arrays
                    name = numbers[start]
                    shard = Shard.unpack(*run.column("arrays")[0].as_py().values())
                    run = run.slice(1)
                a = run.column("h1").fill_null(0).to_numpy()
                b = run.column("h2").fill_null(0).to_numpy()
                found = shard.count(a.view(np.uint64), b.view(np.uint64)) >= min_docs
                yield pa.record_batch(
                    [
                        run.column("_id").filter(pa.array(found)),
                        _digests(a[found], b[found]),
                    ],
                    ["_id", "hit"],
                )

    hits = (
        together.repartition("shard")
        .sortWithinPartitions("shard", "kind")
        .mapInArrow(answer, f"_id {kind}, hit binary")
    )
    return hits.groupBy("_id").agg(F.collect_set("hit").alias("_hits")), hot


def drop_common_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    results: Sequence[str] = RESULTS,
) -> DataFrame:
    """``docs`` plus ``_kept`` text, ``_n_lines``, ``_n_dropped``, ``_kept_sha256``, or as ``results`` names them.

    A line's key is the line without white space at both ends, A-Z lower-cased;
    keys of at least ``min_chars`` code points found in at least ``min_docs`` rows
    lose all their lines. Null and empty texts are one empty line, whose key is
    too short to count. A row that repeats counts as a further document; rows meet
    their lines by id and text together, so a repeated or null id gathers nothing.
    The result keeps every column of ``docs`` (a null text stays null), but for
    columns called like one of the ``results``, which these replace; an empty table
    gives an empty table.
    """
    docs = docs.drop(*results)
    key, found_lines = unused(docs, "_key", "_hits")
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_column), F.col(text)))
    hits, hot = common_lines(keyed, key, text, min_docs, min_chars)
    # Written first: Spark may then split the rows of one id and text in the join.
    hits = materialised(hits).toDF(key, found_lines)
    packed_hot = hot.pack()

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = Shard.unpack(*packed_hot)
        for batch in batches:
            texts, found = batch.column(text), batch.column(found_lines)
            kept, sums, lines, dropped = [], [], [], []
            for _, _, part in slices(texts):
                for row in range(len(part)):
                    body = part.text(row)
                    raw, keys = body.split(b"\n"), _line_keys(body)
                    gone = set(found[len(kept)].as_py() or ())
                    a, b = _hashes(keys)
                    common = often.count(a, b) >= min_docs
                    stay = [
                        line
                        for line, key, often_found in zip(raw, keys, common.tolist(), strict=True)
                        if not _long_enough(key, min_chars)
                        or not (often_found or (gone and xxhash.xxh3_128_digest(key) in gone))
                    ]
                    out = b"\n".join(stay)
                    kept.append(out)
                    lines.append(len(raw))
                    dropped.append(len(raw) - len(stay))
                    sums.append(hashlib.sha256(out).hexdigest())
            rest = [batch.column(c) for c in names]
            yield pa.record_batch(
                [*rest, pa.array(kept, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()),
                 pa.array(dropped, pa.int64()), pa.array(sums, pa.string())],
                [*names, *results],
            )

    names = docs.columns
    joined = keyed.join(hits, key, "left").select(*[F.col(f"`{c}`") for c in (*names, found_lines)])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    kinds = ("string", "long", "long", "string")
    added = ", ".join(f"`{name}` {kind}" for name, kind in zip(results, kinds, strict=True))
    return joined.mapInArrow(rebuild, f"{fields}, {added}")
