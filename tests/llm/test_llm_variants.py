"""Spelling variants against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from contactmine.llm.variants import spelling_variants

SCHEMA = "doc_id long, text string, word string, n long, key string"


def _rows():
    rng = random.Random(5)
    base = ["abcdefg", "aabbccdd", "éclairage", "straßen", "zzzzzzzz", "mississippi", "abcdefgh"]
    words = list(base)
    for w in base * 12:
        k = rng.randrange(len(w))
        words.append(rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abzéß") + w[k + 1 :], w[:k] + rng.choice("abz") + w[k:]]))
    rows = [(None, "Abcdefg " * 9, "x", 1, "y"), (0, None, "x", 1, ""), (1, "", None, None, None), (2, " 12 a-b ", "", 0, "")]
    for k in range(3, 70):
        many = [rng.choice(base) for _ in range(30)] + [rng.choice(words) for _ in range(12)]
        rows.append((k, " ".join(w.upper() if rng.random() < 0.2 else w for w in many) + ".\nfin÷al×es", "x", k, "y"))
    long = " ".join(rng.choice(words) for _ in range(20_000))
    return [*rows, rows[5], rows[5], (99, long, "", 0, "")]


ROWS = _rows()


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def _plain(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    forms, sizes = {}, {}
    for w, n in words.items():
        near = [x for x in words if _near(w, x)]
        sizes[w] = len(near)
        best = min(near, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, forms[w], root, n, sizes[w], words.get(forms[w])))
    return out


@pytest.mark.parametrize("parts", [1, 6])
def test_variants(spark, parts):
    df = spelling_variants(spark.createDataFrame(ROWS, SCHEMA).repartition(parts))
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = _plain(ROWS)
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(want) and set(rows) == want
    assert any(r[1] and r[1] != r[2] for r in want) or any(r[1] for r in want)


def test_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = _plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert {tuple(r) for r in spelling_variants(docs).collect()} == want


def test_empty(spark):
    assert spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0
