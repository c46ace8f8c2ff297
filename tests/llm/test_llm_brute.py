"""The operators against plain Python on small hostile tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contactmine.llm import ngram_join, quality
from contactmine.llm.exact_dedup import exact_groups
from contactmine.llm.language import identify_language, train, training_sample
from contactmine.llm.line_dedup import PerfectHash, drop_common_lines
from contactmine.llm.mixing import fly, mix_sources
from contactmine.llm.ngram_join import similar_groups
from contactmine.llm.packing import pack
from contactmine.llm.scratch import materialised
from contactmine.llm.sanitise import private_spans, sanitised, span_columns
from contactmine.llm.substring_dedup import drop_repeated_windows
from contactmine.llm.token_counts import token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_words long, kept string"


def _table() -> list[tuple]:
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = prose(60)
    near = [rng.choice(words) for _ in range(200)]
    texts = [None, "", " \n\t ", "\n\n", "a", "A a b", "aaa " * 300, "x" * 30_000, prose(30_000)]
    texts += [prose(80) for _ in range(10)] + ["Same Line\n" + prose(20) + "\n  same line\t" for _ in range(12)]
    texts += [prose(20) + "\n" + passage + " " + prose(15) for _ in range(4)] + [prose(40)] * 3
    for k in range(12):
        copy = list(near)
        copy[k * 9] = "changed"
        texts.append(" ".join(copy) + "\n" * k)
    texts += [
        "mail a.b@c.org, x@y.z_q@w.v 1.2.3.4 999.1.1.1 4111 1111 1111 1111 +1 (555) 123-4567 end",
        "<|endoftext|> it's don't wide　space é <|startoftext|>\r\n\x0b\x0c tail ",
        "one two three four",
        "one two three four",
    ]
    rows = [(k, t, "en", None if k % 7 == 0 else f"s{k % 3}", 5, "x") for k, t in enumerate(texts)]
    return [*rows, (None, "nobody " * 3, None, "s1", None, None), rows[12], rows[12]]


ROWS = _table()
EMPTY: list[tuple] = []


@pytest.fixture(scope="module", params=[2, 5])
def docs(spark, request):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(request.param)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame(EMPTY, SCHEMA)


def _rows(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_exact_groups(docs, none):
    plain = [re.sub(r"[\x20\x09-\x0D]+", "", r[1] or "") for r in ROWS]
    groups = defaultdict(list)
    for r, p in zip(ROWS, plain, strict=True):
        groups[p].append(r)
    want = Counter()
    for r, p in zip(ROWS, plain, strict=True):
        best = min(groups[p], key=lambda x: (-len(x[1] or ""), x[0] is not None, x[0] or 0))[0]
        want[r[0], best, len(groups[p]), r[0] == best, hashlib.sha256(p.encode()).hexdigest()] += 1
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert _rows(exact_groups(docs, block=64), *names) == want
    assert exact_groups(none).count() == 0


def test_lines(docs, none):
    key = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s.strip(" \t\n\v\f\r"))
    lines = [(r[1] or "").split("\n") for r in ROWS]
    count = Counter(k for ls in lines for k in {key(x) for x in ls} if k)
    want = Counter()
    for r, ls in zip(ROWS, lines, strict=True):
        kept = [x for x in ls if count[key(x)] < 10]
        text = "\n".join(kept)
        want[r[0], len(ls), len(ls) - len(kept), hashlib.sha256(text.encode()).hexdigest()] += 1
    names = ["doc_id", "_n_lines", "_n_dropped", "_kept_sha256"]
    assert _rows(drop_common_lines(docs), *names) == want
    assert drop_common_lines(none).count() == 0


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**63, 5000).astype(np.uint64))
    hashes = PerfectHash.unpack(*PerfectHash.build(keys).pack())
    assert sorted(hashes.index(keys).tolist()) == list(range(len(keys)))


def test_substrings(docs, none):
    texts = [(r[1] or "").encode().split() for r in ROWS]
    count = Counter(tuple(w[k : k + 35]) for w in texts for k in range(len(w) - 34))
    want = Counter()
    for r, w in zip(ROWS, texts, strict=True):
        gone = set()
        for k in range(len(w) - 34):
            if count[tuple(w[k : k + 35])] > 1:
                gone |= set(range(k, k + 35))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want[r[0], len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    assert _rows(drop_repeated_windows(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert drop_repeated_windows(none).count() == 0


def test_similar(docs, none):
    sets = []
    for r in ROWS:
        w = _words(re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(ROWS)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    best = {}
    for k, r in enumerate(ROWS):
        if r[0] is not None:
            best[find(k)] = min(best.get(find(k), r[0]), r[0])
    want = Counter((r[0], len(s), best.get(find(k))) for k, (r, s) in enumerate(zip(ROWS, sets, strict=True)))
    assert _rows(similar_groups(docs), "doc_id", "n_shingles", "component_id") == want
    assert similar_groups(none).count() == 0


def test_tokens(docs, none):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    want = Counter()
    for r in ROWS:
        n = len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)
        want[r[0], len((r[1] or "").encode()), n, n > 512] += 1
    assert _rows(token_counts(docs, BYTE_BPE), "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts(none, BYTE_BPE).count() == 0


def test_packing(docs, none):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    ids = defaultdict(list)
    for r in ROWS:
        own = np.append(np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids, "<u4"), 2)
        ids[r[0]].append(own.astype("<u4"))
    pieces = pack(docs, WORD_BPE, size=256, windows=3).collect()
    covered, windows = defaultdict(Counter), defaultdict(list)
    for p in pieces:
        own = [x for x in ids[p.doc_id] if len(x) == p.doc_tokens][0]
        assert zlib.crc32(own[p.start : p.start + p.length].tobytes()) == p.ids_crc32
        covered[p.doc_id].update(range(p.start, p.start + p.length))
        windows[p.sequence_id].append((p.offset, p.length))
    for name, own in ids.items():
        assert covered[name] == Counter(k for x in own for k in range(len(x)))
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(len(x) for own in ids.values() for x in own)
    assert len(windows) <= total // 256 + docs.rdd.getNumPartitions()
    assert pack(none, WORD_BPE).count() == 0


def test_mix(docs, none):
    rows = mix_sources(docs).collect()
    sizes = Counter(r.doc_id for r in rows)
    assert sizes == Counter(r[0] for r in ROWS)
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(1.5 * sum(r.size for r in rows))
    assert all(r.taken == r.size * r.copies and r.copies <= 2 for r in rows)
    assert all(r.target <= 2 * r.source_size + 1e-6 for r in rows)
    assert sorted(map(tuple, mix_sources(docs).collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert mix_sources(none).count() == 0


def test_flight_is_balanced():
    rng = random.Random(5)
    sizes = [rng.randint(1, 900) for _ in range(3000)]
    chances = [0.37] * 3000
    out = fly(sizes, chances, "seed")
    assert sum(0 < p < 1 for p in out) <= 2
    assert sum(out) == pytest.approx(sum(chances))
    assert sum(s * p for s, p in zip(sizes, out, strict=True)) == pytest.approx(0.37 * sum(sizes))


def _spans(text):
    digits = lambda v: re.sub(r"\D", "", v)

    def luhn(d):
        twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(d))]
        return sum(v - 9 if v > 9 else v for v in twice) % 10 == 0

    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(digits(v)) <= 19 and luhn(digits(v))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(digits(v)) <= 15),
    ]
    return ",".join(
        f"{k}:{m.start()}:{m.end()}" for k, p, ok in kinds for m in re.finditer(p, text or "") if ok(m[0])
    )


def test_private_spans(docs, none):
    spans = private_spans(docs).select("doc_id", span_columns()["spans"].alias("spans"))
    assert _rows(spans, "doc_id", "spans") == Counter((r[0], _spans(r[1])) for r in ROWS)
    assert private_spans(none).count() == 0


def test_terms_that_give_an_entity_away(spark):
    rng = random.Random(2)
    common = [f"w{k}x" for k in range(50)]
    rows = []
    for k in range(200):
        text = " ".join(rng.choice(common) for _ in range(30))
        if k % 20 == 0:
            text += f"\nwrite to Jane@corp.org at Zanzibar {rng.choice(common)}"
        rows.append((k, text, None, None, None, None))
    docs = spark.createDataFrame(rows, SCHEMA)
    out = {r.doc_id: r for r in private_spans(docs).collect()}
    assert {rows[0][1][s.start : s.end] for s in out[0].term} == {"write", "Zanzibar"}
    assert not out[1].term
    text = sanitised(docs).where("doc_id = 0").first()._sanitised
    assert "[email]" in text and "Jane" not in text and "Zanzibar" not in text


def test_quality(spark, docs, none):
    want = Counter()
    for r in ROWS:
        w = _words(r[1])
        grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        hit = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
        seen, dup = set(), 0
        for line in (r[1] or "").split("\n"):
            if _words(line):
                dup += line in seen
                seen.add(line)
        bad = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        signs = len(re.findall(r"[#*$%&|<>]", r[1] or ""))
        want[r[0], len(w), sum(map(len, w)), signs, dup, len(hit), bad, not bad] += 1
    names = ["doc_id", *quality.BASE, "base_failed", "kept"]
    assert _rows(quality.quality_verdicts(docs, None), *names) == want
    assert quality.quality_verdicts(none, None).count() == 0


def test_trees_are_monotone():
    rng = np.random.default_rng(1)
    features = rng.random((2000, 3))
    good = (features[:, 0] + rng.normal(0, 0.3, 2000) < 0.5).astype(float)
    trees = quality.fit_trees(features, good, [-1, 0, 1])
    line = np.stack([np.linspace(0, 1, 200), np.full(200, 0.5), np.full(200, 0.5)], 1)
    assert (np.diff(trees.score(line)) <= 1e-9).all()
    assert (np.diff(trees.score(line[:, [1, 2, 0]])) >= -1e-9).all()
    assert (((trees.score(features) > 0) == (good > 0)).mean()) > 0.75


def test_language(docs, none):
    model = train(["the and of " * 20, "der die und " * 20] * 10, ["en", "de"] * 10)
    rows = {(r.doc_id, r.lang_pred, r.score) for r in identify_language(docs, model).collect()}
    assert {n for _, n, _ in rows} <= {"en", "de", "und"}
    assert all(0 <= s <= 1 for *_, s in rows)
    assert {k for k, n, _ in rows if n == "und"} == {
        r[0] for r in ROWS if not any(c.isalpha() for c in r[1] or "")
    }
    assert identify_language(none, None).count() == 0


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "packing":
            assert out.columns == docs.columns, name
            docs = materialised(out)
    assert out.count() > 0


def test_buckets_keep_stragglers(spark):
    """Nodes that come after their signature was large in another slice meet all its nodes."""
    template = " ".join(f"t{k}" for k in range(60))
    leaf = lambda k: f"{template} " + " ".join(f"o{k}x{i}" for i in range(14))
    texts = [[template, *map(leaf, range(150))], [leaf(k) for k in range(150, 154)]]
    apart = spark.sparkContext.parallelize(texts, 2).flatMap(lambda each: [(t,) for t in each])
    docs = spark.createDataFrame(apart, "text string")
    differ, overlap = (lambda n: n // 3), (lambda n: -(-3 * n // 4))
    none = np.zeros(0, ngram_join.U64)
    found = ngram_join.buckets(docs, 5, none, 16, differ, overlap).collect()
    pairs = {(r.leader, r.node) for r in found if r.sig is None}
    large = defaultdict(set)
    for r in found:
        if r.sig is not None:
            large[r.sig].add(r.node)
    (_, _, part), *_ = ngram_join.slices(pa.array(texts[0] + texts[1]))
    hashes, first = ngram_join.distinct_sets(*ngram_join.shingles(part, 5))
    nodes = ngram_join._nodes(hashes, first)
    want = defaultdict(set)
    for sig, owner in zip(*ngram_join.signatures(hashes, first, none, differ, overlap), strict=True):
        want[(int(sig) >> 32) % 16 << 32 | int(sig) & 0xFFFFFFFF].add(int(nodes[owner]))
    assert max(map(len, want.values())) > ngram_join.TRIM
    for sig, group in want.items():
        if len(group) > ngram_join.SMALL:
            assert group <= large[sig]
        else:
            assert {(a, b) for a in group for b in group if a < b} <= pairs


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_nearest_in_blocks(spark, monkeypatch, block):
    """Every pair that the sketches allow is tried, and no group holds more than two blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    texts = [" ".join([*base, *(f"o{k}x{i}" for i in range(rng.choice([3, 30, 60])))]) for k in range(40)]
    table = ngram_join.set_table(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 5)
    nodes = {r.node: (r.n, np.frombuffer(r.sketch, ngram_join.U64)) for r in table.where("sketch IS NOT NULL").collect()}
    names = sorted(nodes)
    gone = [(names[0], names[1])]
    rows = [
        (7, k, k % 3, nodes[k][0], bytes(nodes[k][1]), *(([names[1]], 1) if k == names[0] else ([names[0]], 1) if k == names[1] else (None, None)))
        for k in names
    ]
    frame = spark.createDataFrame(
        rows, "sig long, node long, component long, n long, sketch binary, failed array<long>, n_failed int"
    )
    want = set()
    for a in names:
        for b in names:
            if a < b and a % 3 != b % 3 and (a, b) not in gone:
                (an, abits), (bn, bbits) = nodes[a], nodes[b]
                width = min(len(abits), len(bbits))
                apart = np.bitwise_count(ngram_join._folded(abits, width) ^ ngram_join._folded(bbits, width)).sum()
                if abs(an - bn) * 100 <= 25 * max(an, bn) and ngram_join._allowed(apart, an + bn, 75):
                    want.add((a, b))
    assert len(want) > 50
    assert {tuple(r) for r in ngram_join._nearest(frame, 75, 100).collect()} == want
    some = {tuple(r) for r in ngram_join._nearest(frame, 75, 1).collect()}
    assert (7, None) in some and some - {(7, None)} < want
    met = {x for pair in some if pair[1] is not None for x in pair}
    assert met == {x for pair in want for x in pair}
    groups = ngram_join._blocks(frame).groupBy("i", "j").count().collect()
    assert len(groups) > (len(rows) // block) ** 2 // 4


def test_pipeline_decides_by_row(spark):
    """Repeated rows, rows that share an id and rows with null ids, against what each row is worth."""
    import corpus_pipeline

    rng = random.Random(3)
    prose = lambda n: " ".join(f"p{rng.randrange(10**6)}" for _ in range(n))
    a, b, c, d, e = (prose(30) for _ in range(5))
    rows = [(5, a)] * 3 + [(7, b), (7, a), (8, b), (None, c), (None, c), (None, d), (9, d), (None, e)]
    rows += [(3, ""), (3, ""), (None, None), (None, None)]
    table = spark.createDataFrame([(k, t, "s", len(t or "")) for k, t in rows], "doc_id long, text string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicates(spark, table, "")
    assert kept.columns == table.columns
    wordless = [(3, ""), (3, ""), (None, None), (None, None)]
    assert _rows(kept, "doc_id", "text") == Counter([(5, a), (7, b), (None, c), (9, d), (None, e), *wordless])

    words = [(k if k % 3 else None, prose(5 + k % 11)) for k in range(60)] + [(1, prose(9))] * 20
    table = spark.createDataFrame([(k, t, f"s{len(t) % 2}") for k, t in words], "doc_id long, text string, source string")
    taken = corpus_pipeline.source_mix(spark, table, "")
    drawn = mix_sources(corpus_pipeline._keyed(table, "_key"), "_key").groupBy("source").agg({"taken": "sum"}).collect()
    got = Counter()
    for r in taken.collect():
        got[r.source] += len(r.text.split())
    assert got == Counter({r[0]: r[1] for r in drawn})
    times = Counter(r.text for r in taken.collect())
    there = Counter(t for _, t in words)
    assert all(times[t] <= 2 * there[t] for t in times)
    assert _rows(taken, "doc_id", "text") == _rows(corpus_pipeline.source_mix(spark, table.repartition(3), ""), "doc_id", "text")


CLASHING = ["kept", "_kept", "_hits", "_id", "_key", "_rows", "_times", "_n_lines", "_group", "node", "key"]


def test_columns_that_clash(spark, sf_dir):
    """Columns called like those the operators use themselves come out of each stage as they went in."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = [F.concat(F.lit(f"{name}/"), "doc_id").alias(name) for name in CLASHING]
    more = docs.select("*", *extra)
    for name, stage in corpus_pipeline.STAGES[:4]:
        plain, wide = (materialised(stage(spark, t, sf_dir)) for t in (docs, more))
        assert wide.columns == more.columns, name
        if name != "source_mix":  # which rows it draws hangs on all their columns
            assert _rows(plain, *docs.columns) == _rows(wide, *docs.columns), name
        for column in CLASHING:
            assert wide.where(f"`{column}` <> concat('{column}/', doc_id)").count() == 0, (name, column)
    assert wide.count() > 0


def test_rows_alike_and_without_id(spark):
    """Similarity join and line dedup where a third of the rows has no id, or is one row many times."""
    rng = random.Random(5)
    prose = lambda n: " ".join(f"w{rng.randrange(10**5)}" for _ in range(n))
    base = [f"v{k}" for k in range(60)]
    near = [" ".join([*base[:k], "other", *base[k + 1 :]]) for k in (0, 58, 59)]
    rows = [(4, near[0] + "\nfooter")] * 40 + [(None, near[1])] * 5 + [(2, near[2])]
    rows += [(None, prose(30) + "\nfooter") for _ in range(30)] + [(9, prose(12))] * 2
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    groups = Counter((r.doc_id, r.component_id) for r in similar_groups(table).collect())
    assert groups == Counter({(4, 2): 40, (None, 2): 5, (2, 2): 1, (None, None): 30, (9, 9): 2})
    cut = drop_common_lines(table).collect()
    own = [t.split("\n")[0] for _, t in rows]
    assert Counter(r._kept for r in cut) == Counter("" if own.count(t) >= 10 else t for t in own)
    assert sum(r._n_dropped for r in cut) == 40 + 70


def test_terms_of_the_whole_document(spark):
    """A signature block, the same in many documents, and its name elsewhere; copies are no evidence."""
    rng = random.Random(4)
    prose = lambda: " ".join(f"w{rng.randrange(40)}x" for _ in range(30))
    texts = [prose() for _ in range(200)]
    for k in range(0, 200, 20):
        texts[k] = f"Quirrell first\n{texts[k]}\nQuirrell\nContact: jane@x.org"
    texts[7] += "\nas quirrell said"
    texts += ["Solitary\nbob@y.org " + prose()] * 9
    docs = spark.createDataFrame([(k, t, None, None, None, None) for k, t in enumerate(texts)], SCHEMA)
    out = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.term] for r in private_spans(docs).collect()}
    for k in range(0, 200, 20):
        assert out[k] == ["Quirrell", "first", "Quirrell", "Contact"]
    assert out[7] == ["quirrell"]
    assert not any(out[k] for k in out if k >= 200 or k % 20 and k != 7)


def test_terms_of_rare_entities(spark):
    """Names in an address of their own, and names met beside many addresses of one domain, each met once."""
    rng = random.Random(6)
    prose = lambda: " ".join(f"w{rng.randrange(60)}x" for _ in range(40))
    texts = [prose() for _ in range(1000)]
    planted = {}
    for k in range(40):  # the name is a part of the only address
        name = "Lind" + "abcdefgh"[k % 8] + "klmnp"[k // 8] + "vist"
        texts[k] += f"\nsays {name} to {name.lower()}.{k}@host{k}.net"
        planted[k] = [name]
    for k in range(100, 140):  # ten firms, four people each, one address a person
        firm = "Werk" + "abcdefghij"[(k - 100) // 4]
        texts[k] += f"\n{firm}: p{k}@dom{(k - 100) // 4}.org"
        planted[k] = [firm]
    docs = spark.createDataFrame([(k, t, None, None, None, None) for k, t in enumerate(texts)], SCHEMA)
    out = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.term] for r in private_spans(docs).collect()}
    caught = sum(set(want) <= set(out[k]) for k, want in planted.items())
    assert caught >= 0.9 * len(planted)
    assert not any(out[k] for k in out if k not in planted)


def test_all_languages_are_learned(spark):
    rows = [(3 * k + i, f"tongue{k} " * 5, f"l{k:03}") for k in range(230) for i in range(3 if k else 9)]
    docs = spark.createDataFrame([(10 * i + j, t, n) for i, t, n in rows for j in range(4)], "doc_id long, text string, lang string")
    sample = training_sample(docs)
    assert set(sample.column("lang").to_pylist()) == {f"l{k:03}" for k in range(230)}
    model = train(["alpha beta"] * 4 + ["gamma delta"], ["a"] * 4 + ["b"], epochs=60)
    assert model.names == ["a", "b"]
    found = identify_language(spark.createDataFrame([(1, "gamma delta")], "doc_id long, text string"), model)
    assert found.first().lang_pred == "b"


def test_sample_of_a_hot_language(spark):
    """The smallest hashes of each language, whichever share of the rows it has; bytes are bounded, rows alike count once."""
    rows = [(k, f"text {k}", "hot" if k % 3 else f"l{k % 9}") for k in range(3000)] + [(7, "text 7", "hot")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    hashed = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).distinct().collect()}
    want = set()
    for lang in {r[2] for r in rows}:
        usable = [r for r in set(rows) if r[2] == lang and zlib.crc32(str(r[0]).encode()) % 4 != 2]
        want |= {r[0] for r in sorted(usable, key=lambda r: (hashed[r[0]], r[0]))[:40]}
    assert set(training_sample(docs, 40).column("doc_id").to_pylist()) == want
    few = training_sample(docs, 40, most_bytes=200)
    assert set(few.column("lang").to_pylist()) == {r[2] for r in rows}
    assert sum(map(len, few.column("text").to_pylist())) <= 200
