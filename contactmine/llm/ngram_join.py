"""N-gram Jaccard join with PartEnum signatures.

Sets of at most a factor ``BAND`` in size share a band; a band fixes a partition
of the feature domain. Two linked sets differ in few features, so most parts of
the partition hold the same features in both: the features of one part, hashed,
are a signature, and linked sets share signatures. A set takes part in its own
band and in the next one if a partner could lie there.

Which signatures are needed follows from counting. A set of n features differs
from a partner that is not smaller in at most n/3 features (for similarity
0.75), and from one that is not larger in fewer. With more than n/3 non-empty
parts at least one agrees, and of all non-empty parts in one fixed order the
first n/3 + 1 suffice on one side and on the other. The order puts parts made
of very frequent shingles last: where a passage is in a great many documents,
its parts seldom count. A set with too few non-empty parts also enumerates its
first n/4 + 1 single features, so that two such sets meet there.

Sets that are equal are one node. Signatures travel packed, twelve bytes each,
to their shard. Small buckets give all their pairs; a large bucket gives only
stars around its smallest nodes; then, round after round, each node tries the
nearest nodes of other components that it has not tried (one, then sixteen times
as many each round), until its members are one component or no pair is left that
could be linked. A bucket of many nodes is dealt into blocks, and each pair of
blocks is a group of its own. Large buckets of the same nodes count once. Pairs are first
tested with bit sketches (whose distance never exceeds the true one), then
verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from contactmine.llm.components import components
from contactmine.llm.scratch import materialised, shards_for
from contactmine.llm.textbytes import U64, distinct_sets, mix, shingles, slices

BAND = 4
LEAST_BITS = 512
SMALL = 8  # buckets of so many nodes give all pairs
TRIM = 64  # in one slice, larger buckets send their smallest node only
MOST_FREQUENT = 20_000  # shingles that are sorted last
STAR_ROUNDS = 2
MOST_BROADCAST = 200_000  # rows of two numbers
BLOCK = 4096  # nodes of a large bucket that are compared in one task with as many others
BLOCK_BYTES = 1 << 24
MOST_SAID = 1 << 18  # pairs that a task remembers, so as not to repeat them
_PENDING = 1 << 21


def _sketches(hashes: np.ndarray, first: np.ndarray) -> pa.Array:
    """Bits of each set; bit i is the parity of the features that fall on it.

    So the bits of two sets differ in no more places than the sets. There are two
    to four bits a feature, a power of two: folding the halves of a sketch onto
    each other gives the sketch of half the width.
    """
    sizes = np.diff(first)
    width = 2 ** np.ceil(np.log2(np.maximum(2 * sizes, LEAST_BITS))).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(width)])
    rows = np.repeat(np.arange(len(sizes)), sizes)
    place = (mix(hashes ^ U64(0x5BD1E995)) & (width[rows] - 1).astype(U64)).astype(np.int64)
    odd = np.bincount(base[rows] + place, minlength=base[-1]) & 1
    body = np.packbits(odd.astype(np.uint8))
    return pa.Array.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(base // 8), pa.py_buffer(body)]
    ).cast(pa.binary())


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Sketches (rows of 64-bit words) at a smaller width."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def _nodes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set."""
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(hashes), dtype=U64)])
    return mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(U64)).view(np.int64)


def _text_key() -> Column:
    return F.xxhash64("doc_id", "text").alias("text_key")


def set_table(docs: DataFrame, length: int) -> DataFrame:
    """``doc_id``, ``text_key``, ``n``, ``node``, ``sketch`` per row; and frequent shingles per slice.

    Rows of one id and text share ``text_key``, by which a text is found again.

    Rows with null ``sketch`` are shingles: ``node`` the shingle, ``n`` documents of
    the slice that hold it (one in a hundred of them at least).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, part in slices(batch.column(1)):
                hashes, first = distinct_sets(*shingles(part, length))
                names = ["doc_id", "text_key", "n", "node", "sketch"]
                yield pa.record_batch(
                    [
                        batch.column(0).slice(low, high - low),
                        batch.column(2).slice(low, high - low),
                        pa.array(np.diff(first)),
                        pa.array(_nodes(hashes, first)),
                        _sketches(hashes, first),
                    ],
                    names,
                )
                found, counts = np.unique(hashes, return_counts=True)
                often = counts >= max(8, len(part) // 100)
                none = int(often.sum())
                yield pa.record_batch(
                    [
                        pa.nulls(none, batch.column(0).type),
                        pa.nulls(none, pa.int64()),
                        pa.array(counts[often].astype(np.int64)),
                        pa.array(found[often].view(np.int64)),
                        pa.nulls(none, pa.binary()),
                    ],
                    names,
                )

    return docs.select("doc_id", "text", _text_key()).mapInArrow(
        run, f"doc_id {kind}, text_key long, n long, node long, sketch binary"
    )


def signatures(
    hashes: np.ndarray, first: np.ndarray, frequent: np.ndarray, differ: Callable, overlap: Callable
) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of all sets, and the set each belongs to.

    ``differ(n)``: most features in which a set of n differs from a partner that
    is not smaller; ``overlap(n)``: fewest features it shares with a partner.
    ``frequent``: sorted shingles that come last in the order.
    """
    sizes = np.diff(first)
    often = np.zeros(len(hashes), bool)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        often = frequent[at] == hashes
    out, owners = [], []
    band = np.zeros(len(sizes), np.int64)
    for step in range(1, 32):
        band[sizes >= BAND**step] = step
    for ahead in (0, 1):
        level = band + ahead
        # A partner of the next band has BAND^level features at least.
        takes = (sizes > 0) & ((ahead == 0) | (sizes + differ(sizes) >= BAND ** level.astype(float)))
        rows = np.flatnonzero(takes)
        if not len(rows):
            continue
        top = float(BAND) ** (level[rows] + 1)
        parts = np.ceil(np.maximum(0.45 * top, np.minimum(2 * top, 48))).astype(np.int64)
        base = np.concatenate([[0], np.cumsum(parts)])
        own = np.repeat(np.arange(len(rows)), sizes[rows])
        at = np.repeat(first[rows] - np.concatenate([[0], np.cumsum(sizes[rows])[:-1]]), sizes[rows])
        at = at + np.arange(len(own))
        spread = mix(hashes[at] + level[rows][own].astype(U64))
        part = (spread % parts[own].astype(U64)).astype(np.int64)
        cell = base[own] + part
        # Non-empty parts only: the partition is many times as wide as the set.
        full, slot = np.unique(cell, return_inverse=True)
        rare = np.bincount(slot[~often[at]], minlength=len(full)) > 0
        content = np.zeros(len(full), U64)
        np.add.at(content, slot, mix(spread))
        row = np.searchsorted(base, full, side="right") - 1
        # Place in the order: parts with a rare feature first, then by number.
        order = np.argsort(2 * row + ~rare, kind="stable")
        full, row, content = full[order], row[order], content[order]
        filled_parts = np.bincount(row, minlength=len(rows))
        start = np.concatenate([[0], np.cumsum(filled_parts)])
        rank = np.arange(len(full)) - start[row]
        most = differ(sizes[rows])
        keep = rank <= most[row]
        tag = mix((level[rows][row] << 32 | (full - base[row])).astype(U64))
        out.append(mix(content ^ tag)[keep])
        owners.append(rows[row[keep]])
        # Sets that may agree with a partner in no non-empty part.
        unsafe = filled_parts <= most
        single = unsafe[own]
        if single.any():
            own, value = own[single], hashes[at[single]]
            order = np.lexsort((value, often[at[single]], own))
            own, value = own[order], value[order]
            start = np.searchsorted(own, own)
            need = sizes[rows] - overlap(sizes[rows]) + 1
            keep = np.arange(len(own)) - start < need[own]
            out.append(mix(mix(value) + level[rows][own].astype(U64) + U64(77))[keep])
            owners.append(rows[own[keep]])
    if not out:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owners)


def _groups(sig: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (sig, node) in order, and the start of each signature (and the end)."""
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
    sig, node = sig[new], node[new]
    edge = np.flatnonzero(np.diff(sig, prepend=sig[:1] - 1)) if len(sig) else np.zeros(0, np.int64)
    return sig, node, np.append(edge, len(sig))


def _bucket_rows(
    sig: np.ndarray, node: np.ndarray, edge: np.ndarray, known: np.ndarray
) -> pa.RecordBatch:
    """Buckets as rows: pairs (sig null) of small ones, (sig, node, leader) of large ones.

    ``known``: signatures that have rows of a large bucket already; whatever comes
    later belongs to that bucket.
    """
    sizes = np.diff(edge)
    large = (sizes > SMALL) | ((sizes >= 2) & np.isin(sig[edge[:-1]], known))
    small = (sizes >= 2) & ~large
    starts, lengths = edge[:-1][small], sizes[small]
    pairs = []
    for i in range(SMALL - 1):
        for j in range(i + 1, SMALL):
            at = starts[lengths > j]
            pairs.append(np.stack([node[at + i], node[at + j]], 1))
    found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
    big = np.repeat(large, sizes)
    leader = np.repeat(node[edge[:-1]], sizes)[big] if len(sizes) else node
    none = np.concatenate([np.ones(len(found), bool), np.zeros(int(big.sum()), bool)])
    value = np.concatenate([np.zeros(len(found), np.int64), sig[big]])
    return pa.record_batch(
        [
            pa.array(value, mask=none),
            pa.array(np.concatenate([found[:, 1], node[big]])),
            pa.array(np.concatenate([found[:, 0], leader])),
        ],
        ["sig", "node", "leader"],
    )


def buckets(
    docs: DataFrame, length: int, frequent: np.ndarray, shards: int, differ: Callable, overlap: Callable
) -> DataFrame:
    """``sig``, ``node``, ``leader``: the signatures that two nodes or more share."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # nodes this task has sent already
        names = ["shard", "sig", "node", "leader"]
        for batch in batches:
            for _, _, part in slices(batch.column(0)):
                hashes, first = distinct_sets(*shingles(part, length))
                nodes = _nodes(hashes, first)
                fresh = []
                for row, name in enumerate(nodes.tolist()):
                    if first[row] < first[row + 1] and name not in seen:
                        seen.add(name)
                        fresh.append(row)
                if not fresh:
                    continue
                sizes = np.diff(first)[fresh]
                body = np.concatenate([hashes[first[r] : first[r + 1]] for r in fresh])
                edges = np.concatenate([[0], np.cumsum(sizes)])
                value, owner = signatures(body, edges, frequent, differ, overlap)
                shard = ((value >> U64(32)) % U64(shards)).astype(np.int64)
                sig = shard << 32 | (value & U64(0xFFFFFFFF)).astype(np.int64)
                sig, node, edge = _groups(sig, nodes[fresh][owner])
                counts = np.diff(edge)
                large = np.repeat(counts > TRIM, counts)
                if large.any():
                    leader = np.repeat(node[edge[:-1]], counts)
                    yield pa.record_batch(
                        [
                            pa.array([int(sig[0] >> 32)], pa.int32()),
                            *(pa.array([x[large].tobytes()], pa.binary()) for x in (sig, node, leader)),
                        ],
                        names,
                    )
                    # The shard of each of these signatures is told of them.
                    told = np.unique(sig[large])
                    for each in np.split(told, np.flatnonzero(np.diff(told >> 32)) + 1):
                        yield pa.record_batch(
                            [
                                pa.array([int(each[0] >> 32)], pa.int32()),
                                pa.array([each.tobytes()], pa.binary()),
                                *(pa.nulls(1, pa.binary()) for _ in range(2)),
                            ],
                            names,
                        )
                keep = ~large
                keep[edge[:-1]] = True
                sig, node = sig[keep], node[keep]
                cuts = np.flatnonzero(np.diff(sig >> 32, prepend=-1))
                low = (sig & 0xFFFFFFFF).astype("<u4")
                ends = [*cuts[1:].tolist(), len(sig)]
                spans = list(zip(cuts.tolist(), ends, strict=True))
                yield pa.record_batch(
                    [
                        pa.array((sig[cuts] >> 32).astype(np.int32)),
                        pa.array([low[a:b].tobytes() for a, b in spans], pa.binary()),
                        pa.array([node[a:b].tobytes() for a, b in spans], pa.binary()),
                        pa.nulls(len(spans), pa.binary()),
                    ],
                    names,
                )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sigs, nodes, held = -1, [], [], 0
        known: list[np.ndarray] = []  # signatures of the shard that were large before

        def close(last: bool) -> Iterator[pa.RecordBatch]:
            """Rows of the shard so far; large buckets leave only their leader behind."""
            nonlocal sigs, nodes, held, known
            if not sigs:
                return
            known = [np.unique(np.concatenate([np.zeros(0, np.int64), *known]))]
            sig, node, edge = _groups(np.concatenate(sigs), np.concatenate(nodes))
            sigs, nodes, held = [], [], 0
            if last:
                yield _bucket_rows(sig, node, edge, known[0])
                known = []
                return
            sizes = np.diff(edge)
            big = np.repeat(sizes > max(SMALL, 1000), sizes)
            sub_sig, sub_node = sig[big], node[big]
            if len(sub_sig):
                yield _bucket_rows(*_groups(sub_sig, sub_node), known[0])
                known.append(np.unique(sub_sig))
            rest = ~big
            rest[edge[:-1]] = True
            sigs, nodes, held = [sig[rest]], [node[rest]], int(rest.sum())

        limit = _PENDING
        for batch in batches:
            for row in range(batch.num_rows):
                shard, a, b, c = (batch.column(k)[row].as_py() for k in range(4))
                if shard != now:
                    yield from close(True)
                    now, limit = shard, _PENDING
                if b is None:  # signatures that were large in a slice
                    known.append(np.frombuffer(a, np.int64))
                    continue
                node = np.frombuffer(b, np.int64)
                if c is not None:  # a bucket that was large in its slice
                    yield pa.record_batch(
                        [np.frombuffer(a, np.int64), node, np.frombuffer(c, np.int64)],
                        ["sig", "node", "leader"],
                    )
                    continue
                sigs.append(np.frombuffer(a, "<u4").astype(np.int64) | (shard << 32))
                nodes.append(node)
                held += len(node)
                if held > limit:
                    yield from close(False)
                    limit = max(_PENDING, 2 * held)
        yield from close(True)

    return (
        docs.select("text")
        .mapInArrow(send, "shard int, sig binary, node binary, leader binary")
        .repartition(shards, "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(gather, "sig long, node long, leader long")
    )


def _close_sketches(pairs: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b, c) whose sketches allow a link."""
    left = nodes.selectExpr("node AS a", "n AS an", "sketch AS asketch")
    right = nodes.selectExpr("node AS b", "n AS bn", "sketch AS bsketch")
    joined = pairs.join(left, "a").join(right, "b")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = np.zeros(batch.num_rows, np.int64)
            sides = (batch.column(c).to_pylist() for c in ("asketch", "bsketch"))
            for row, (a, b) in enumerate(zip(*sides, strict=True)):
                a, b = np.frombuffer(a, U64), np.frombuffer(b, U64)
                width = min(len(a), len(b))
                apart[row] = np.bitwise_count(_folded(a, width) ^ _folded(b, width)).sum()
            total = batch.column("an").to_numpy() + batch.column("bn").to_numpy()
            ok = pa.array(_allowed(apart, total, threshold))
            yield pa.record_batch([batch.column(c).filter(ok) for c in ("a", "b", "c")], ["a", "b", "c"])

    return joined.select("a", "b", "c", "an", "bn", "asketch", "bsketch").mapInArrow(
        test, "a long, b long, c long"
    )


def _allowed(apart: np.ndarray, total: np.ndarray, threshold: int) -> np.ndarray:
    # |A xor B| = total - 2 i, and 100 i >= threshold (total - i).
    return apart * (100 + threshold) <= total * (100 - threshold)


def _small(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if it is known to have few rows (of two longs or an id)."""
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def _labels(links: DataFrame) -> DataFrame:
    """The components of these links, as a table."""
    return materialised(components(links), 2 * links.count())


class _Verifier:
    """Tests pairs of nodes on their whole sets, which are read once per node."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, length: int, threshold: int, repeated: bool):
        self.docs, self.nodes = docs, nodes
        self.repeated = repeated  # some rows are alike in id and text
        self.length, self.threshold = length, threshold
        self.sets: DataFrame | None = None  # node, features

    def _fetch(self, pairs: DataFrame) -> None:
        length = self.length
        needed = pairs.selectExpr("a AS node").union(pairs.selectExpr("b AS node")).distinct()
        if self.sets is not None:
            needed = needed.join(self.sets.select("node"), "node", "left_anti")
        rows = _small(
            materialised(needed.join(self.nodes, "node").select("text_key", "node"))
        )
        texts = self.docs.select("text", _text_key()).join(rows, "text_key")
        if self.repeated:  # one of the rows of each node, the first found by each task
            texts = texts.groupBy("node", "text_key").agg(F.first("text").alias("text"))

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for low, _, part in slices(batch.column(1)):
                    hashes, first = distinct_sets(*shingles(part, length))
                    own = _nodes(hashes, first)
                    asked = batch.column(0).slice(low, len(part)).to_numpy()
                    rows = np.flatnonzero(own == asked)  # another text may share the key
                    yield pa.record_batch(
                        [
                            pa.array(asked[rows]),
                            pa.array([hashes[first[r] : first[r + 1]].tobytes() for r in rows], pa.binary()),
                        ],
                        ["node", "features"],
                    )

        sets = texts.select("node", "text").mapInArrow(whole, "node long, features binary")
        sets = materialised(sets)
        self.sets = sets if self.sets is None else self.sets.union(sets)

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are linked."""
        threshold = self.threshold
        pairs = materialised(pairs)
        count = pairs.count()
        self._fetch(pairs)
        asked = _small(pairs)
        sides = [
            self.sets.selectExpr(f"node AS {side}", f"features AS f{side}").join(asked, side)
            for side in "ab"
        ]
        joined = sides[0].join(sides[1], ["a", "b"])

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                linked = np.zeros(batch.num_rows, bool)
                for row in range(batch.num_rows):
                    a, b = (np.frombuffer(batch.column(k)[row].as_py(), U64) for k in (2, 3))
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    linked[row] = 100 * both >= threshold * (len(a) + len(b) - both)
                keep = pa.array(linked)
                yield pa.record_batch(
                    [batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"]
                )

        return materialised(
            joined.select("a", "b", "fa", "fb").mapInArrow(compare, "a long, b long"), 50 * count
        )


def _blocks(rows: DataFrame) -> DataFrame:
    """``rows`` of large buckets, once for each pair of blocks (i <= j) of the bucket to be compared.

    A bucket has as many blocks as keep each to some thousand nodes and few MB;
    ``block`` is the row's own.
    """
    weight = F.greatest(F.lit(64), F.col("n") / 2) + 8 * F.coalesce("n_failed", F.lit(0))
    sizes = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("rows"), F.sum(weight).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    several = sizes.select("sig", blocks.alias("blocks")).where("blocks > 1")
    dealt = rows.join(several, "sig", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.expr("int(pmod(xxhash64(node, 2L), blocks))"))
    pairs = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return pairs.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})


def _nearest(rows: DataFrame, threshold: int, tries: int) -> DataFrame:
    """For each node of a bucket the nearest nodes there of other components.

    Nearest by sketch, among those it allows a link with and that have not
    failed with this node already (``failed``): its nearest of all, and the
    ``tries`` nearest that come after it. A row (sig, null) says that pairs of
    the bucket are left beyond those. Pairs of blocks are compared in tasks of
    their own; what they find nearest is ranked together. A bucket of one block
    is ranked where it is compared, and a task says a pair once, in however many
    of its buckets the two are nearest.
    """
    names = ["sig", "node", "other", "far", "own"]

    def settled(said: set[tuple[int, int]], found: pa.RecordBatch) -> pa.RecordBatch:
        """Pairs of a bucket of one block that this task has not said yet, as rows without ``sig``."""
        one, two = (found.column(c).to_numpy() for c in ("node", "other"))
        pairs = np.unique(np.stack([np.minimum(one, two), np.maximum(one, two)], 1), axis=0)
        fresh = [p for p in map(tuple, pairs.tolist()) if p not in said]
        if len(said) > MOST_SAID:
            said.clear()
        said.update(fresh)
        a, b = (pa.array([p[k] for p in fresh], pa.int64()) for k in (0, 1))
        n = len(fresh)
        return pa.record_batch([pa.nulls(n, pa.int64()), a, b, pa.nulls(n, pa.float64()), pa.nulls(n, pa.bool_())], names)

    def more(sig: int) -> pa.RecordBatch:
        """The row that says that a bucket has pairs left."""
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_())
        return pa.record_batch([pa.array([sig if k == 0 else None], t) for k, t in enumerate(kinds)], names)

    def compare(sig: int, cross: bool, whole: bool, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        node, component, n, second = (np.array(x) for x in list(zip(*rows, strict=True))[:4])
        failed = [r[5] for r in rows]
        words = np.array([len(r[4]) // 8 for r in rows])
        best, partner = np.full(len(node), np.inf), np.full(len(node), -1)
        tried = []
        most, beyond = tries if whole else tries + 1, False  # one more shows that pairs are left

        def found(k: np.ndarray, other: np.ndarray, far: np.ndarray, own: bool) -> pa.RecordBatch:
            columns = [np.full(len(k), sig), node[k], node[other], far, np.full(len(k), own)]
            return pa.record_batch([pa.array(c) for c in columns], names)

        # Linked sets differ in size by a third at most: in width by one step.
        for width in np.unique(words).tolist():
            own, wide = np.flatnonzero(words == width), np.flatnonzero(words == 2 * width)
            ends = np.full(len(own), len(own) + len(wide))
            starts = np.arange(1, len(own) + 1)
            if cross:  # in the order: first block, second block, wide of the second, wide of the first
                own = own[np.argsort(second[own], kind="stable")]
                wide = wide[np.argsort(~second[wide], kind="stable")]
                first, later_wide = int((~second[own]).sum()), int(second[wide].sum())
                starts = np.where(second[own], len(own) + later_wide, first)
                ends = np.where(second[own], ends, len(own) + later_wide)
            at = np.concatenate([own, wide])
            bits = [np.frombuffer(b"".join(rows[k][4] for k in x), U64) for x in (own, wide)]
            bits = np.concatenate(
                [bits[0].reshape(-1, width), _folded(bits[1].reshape(-1, 2 * width), width)]
            )
            for i, (k, start, end) in enumerate(zip(own.tolist(), starts.tolist(), ends.tolist(), strict=True)):
                later = np.flatnonzero(component[at[start:end]] != component[k]) + start
                other = at[later]
                near = np.abs(n[other] - n[k]) * 100 <= (100 - threshold) * np.maximum(n[other], n[k])
                if failed[k] is not None:
                    near &= ~np.isin(node[other], failed[k])
                later, other = later[near], other[near]
                apart = np.bitwise_count(bits[later] ^ bits[i]).sum(axis=1, dtype=np.int64)
                ok = _allowed(apart, n[other] + n[k], threshold)
                other = other[ok]
                if len(other):
                    far = apart[ok] / (n[other] + n[k])
                    closer = far < best[other]
                    best[other[closer]], partner[other[closer]] = far[closer], k
                    if len(other) > most:
                        beyond = True
                        some = np.lexsort((node[other], far))[:most]
                        other, far = other[some], far[some]
                    tried.append((np.full(len(other), k), other, far))
                    if sum(len(t[1]) for t in tried[-64:]) > 1 << 16 or len(tried) > 1 << 12:
                        yield found(*map(np.concatenate, zip(*tried, strict=True)), True)
                        tried = []
        if tried:
            yield found(*map(np.concatenate, zip(*tried, strict=True)), True)
        some = np.flatnonzero(partner >= 0)
        if len(some):
            yield found(some, partner[some], best[some], False)
        if whole and beyond:
            yield more(sig)

    def told(said: set, now: tuple, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        sig, i, j, blocks = now
        for batch in compare(sig, i < j, blocks == 1, rows):
            whole = blocks == 1 and batch.column("other").null_count == 0
            yield settled(said, batch) if whole else batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        said: set[tuple[int, int]] = set()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(9)]
            lists = batch.column(9)
            bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            for k, (sig, i, j, blocks, block, *row) in enumerate(zip(*columns, strict=True)):
                if (sig, i, j, blocks) != now and rows:
                    yield from told(said, now, rows)
                    rows = []
                now = sig, i, j, blocks
                low, high = bounds[k], bounds[k + 1]
                # A copy, so that the batch is not kept.
                failed = values[low:high].copy() if lists[k].is_valid and high > low else None
                node, component, n, sketch = row
                rows.append((node, component, n, block == j, sketch, failed))
        if rows:
            yield from told(said, now, rows)

    each = materialised(
        _blocks(rows)
        .select("sig", "i", "j", "blocks", "block", "node", "component", "n", "sketch", "failed")
        .repartition("sig", "i", "j")
        .sortWithinPartitions("sig", "i", "j", "node")
        .mapInArrow(run, "sig long, node long, other long, far double, own boolean")
    )
    rank = F.row_number().over(Window.partitionBy("sig", "node", "own").orderBy("far", "other"))
    most = F.when(F.col("own"), tries + 1).otherwise(1)
    known = each.where("sig IS NULL OR node IS NULL").select(F.coalesce("sig", "node").alias("a"), F.col("other").alias("b"))
    open_rows = each.where("sig IS NOT NULL AND node IS NOT NULL")
    ranked = open_rows.withColumn("rank", rank).where(F.col("rank") <= tries + 1).where(F.col("rank") <= most)
    a, b = F.least("node", "other"), F.greatest("node", "other")
    left = F.col("rank") > tries
    named = ranked.select(F.when(left, F.col("sig")).otherwise(a).alias("a"), F.when(~left, b).alias("b"))
    return known.union(named).distinct()


def similar_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    length: int = 5,
    threshold: int = 75,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``: one row per row of ``docs``.

    Two rows link when the Jaccard similarity of their sets of ``length``-word
    shingles (A-Z lower-cased; a shorter text is one shingle) is ``threshold``
    percent or more; ``component_id`` is the smallest id reachable by links. Null,
    empty and wordless texts have no shingles and are linked with nothing.
    Repeated rows are equal sets and so linked. A null id is never the smallest
    unless its whole component is null. Other columns are ignored; an empty
    table gives an empty table.
    """
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))

    def differ(n):
        return n * (100 - threshold) // threshold

    def overlap(n):
        return -(-n * threshold // 100)

    table = materialised(set_table(docs, length))
    rows = table.where("sketch IS NOT NULL")
    total = rows.count()
    often = (
        table.where("sketch IS NULL")
        .groupBy("node")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= max(16, total // 500))
        .orderBy(F.desc("n"), "node")
        .limit(MOST_FREQUENT)  # only an order depends on them
        .toArrow()
    )
    frequent = np.sort(often.column("node").to_numpy().view(U64))
    nodes = materialised(
        rows.where("n > 0")
        .groupBy("node")
        .agg(F.min("text_key").alias("text_key"), F.max("n").alias("n"),
             F.max("sketch").alias("sketch"), F.min("doc_id").alias("doc_id"))
    )
    found = materialised(buckets(docs, length, frequent, shards_for(docs), differ, overlap))
    large = found.where("sig IS NOT NULL")
    repeated = not rows.where("n > 0").groupBy("text_key").count().where("count > 1").isEmpty()
    verifier = _Verifier(docs, nodes, length, threshold, repeated)

    def plausible(heads: DataFrame) -> DataFrame:
        """(a, b) of nodes and leaders, and c, how often they met."""
        met = heads.selectExpr("least(node, leader) AS a", "greatest(node, leader) AS b")
        met = met.where("a <> b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"))
        return materialised(_close_sketches(met, nodes, threshold))

    def stars(pairs: DataFrame) -> DataFrame:
        """One pair per node: with the smaller node it met most often."""
        return pairs.groupBy("b").agg(F.max_by("a", F.struct("c", "a")).alias("a")).select("a", "b")

    # One pair per node first; of the others only those between components.
    pairs = plausible(found)
    first = stars(pairs)
    links = verifier.linked(first)
    labels = _labels(links)
    rest = pairs.select("a", "b")
    for side in "ab":
        label = labels.selectExpr(f"node AS {side}", f"component AS {side}c")
        rest = rest.join(label, side, "left")
    rest = rest.where("ac IS NULL OR bc IS NULL OR ac <> bc").select("a", "b")
    known = labels.where("node <> component").selectExpr("node AS a", "component AS b")
    labels = _labels(known.union(verifier.linked(rest.join(first, ["a", "b"], "left_anti"))))
    large = large.select("sig", "node").distinct()
    members = large.groupBy("sig").agg(
        F.count("node").alias("n"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x"),
    )
    large = large.join(members.groupBy("n", "s", "x").agg(F.min("sig").alias("sig")).select("sig"), "sig")
    star_rounds, tries, failed = 0, 1, []
    held = found.count()  # rows of large buckets at most
    while True:
        # Large buckets whose nodes are not one component yet.
        named = large.select("sig", "node").join(labels, "node", "left")
        named = named.select("sig", "node", F.coalesce("component", "node").alias("component"))
        spans = named.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        large = materialised(named.join(spans.where("lo <> hi").select("sig"), "sig"), held)
        held = large.count()
        if not held:
            break
        star_rounds += 1
        if star_rounds <= STAR_ROUNDS:
            turn = F.xxhash64("node", F.lit(star_rounds))
            heads = large.groupBy("sig").agg(
                F.min_by("node", turn).alias("leader"), F.min_by("component", turn).alias("other")
            )
            heads = large.join(heads, "sig").where("component <> other")
            tried = stars(plausible(heads))
        else:
            once = reduce(DataFrame.union, failed)
            by_node = once.selectExpr("a AS node", "b AS other").union(once.selectExpr("b", "a"))
            by_node = by_node.groupBy("node").agg(F.collect_set("other").alias("failed"))
            by_node = materialised(by_node.withColumn("n_failed", F.size("failed")))
            rows_of_buckets = large.join(nodes, "node").join(by_node, "node", "left")
            near = materialised(_nearest(rows_of_buckets, threshold, tries))
            tries *= 16
            tried = near.where("b IS NOT NULL")
            # Only these buckets hold pairs of different components yet to be tried.
            large = large.join(near.where("b IS NULL").selectExpr("a AS sig"), "sig")
        tried = materialised(tried)
        new = verifier.linked(tried)
        failed.append(tried.join(new, ["a", "b"], "left_anti"))
        if not new.isEmpty():
            # What is known already comes as stars, so that few rounds are left to do.
            known = labels.where("node <> component").selectExpr("node AS a", "component AS b")
            labels = _labels(known.union(new))
    by_node = nodes.select("node", F.col("doc_id").alias("rep"))
    named = by_node.join(labels, "node", "left")
    smallest = named.groupBy(F.coalesce("component", "node").alias("component")).agg(
        F.min("rep").alias("component_id")
    )
    classes = named.select("node", F.coalesce("component", "node").alias("component")).join(
        smallest, "component"
    )
    return rows.join(classes.select("node", "component_id"), "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
