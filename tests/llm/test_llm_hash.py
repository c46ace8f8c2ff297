"""Hashes, the piece encoder and slices of a few bytes against plain Python."""

from __future__ import annotations

import public_tokenizers
import numpy as np
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from contactmine.llm import pieces, textbytes
from contactmine.llm.ngram_join import similar_groups
from contactmine.llm.packing import pack
from contactmine.llm.pieces import PieceEncoder
from contactmine.llm.quality import quality_verdicts
from contactmine.llm.substring_dedup import drop_repeated_windows
from contactmine.llm.textbytes import shingles, slices, span_hashes, window_hashes
from contactmine.llm.token_counts import token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _morse(n: int, a: str, b: str) -> list[str]:
    return [a if bin(k).count("1") % 2 == 0 else b for k in range(n)]


# Sums of powers cannot tell these from each other, whatever the odd base.
MIRRORED = ["".join(_morse(1024, "a", "b")), "".join(_morse(1024, "b", "a"))]
TEXTS = [
    *MIRRORED,
    " ".join(MIRRORED),
    " ".join(_morse(1024, "on", "to")),
    " ".join(_morse(1024, "to", "on")),
    "\n".join(MIRRORED + ["x y"] * 3),
    "<|endoftext|> <|ENDOFTEXT|> it's  don't\n\n x ",
    "",
    None,
    "a",
    "word " * 700 + "é è" * 500,
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), SCHEMA).repartition(2)


def test_span_hashes():
    data = np.frombuffer("".join(MIRRORED).encode() + b"abcab", np.uint8)
    starts = np.array([0, 1024, 0, 2048, 2051, 5, 5])
    ends = np.array([1024, 2048, 1023, 2050, 2053, 5, 6])
    hashes = span_hashes(data, starts, ends).tolist()
    assert hashes[3] == hashes[4]
    assert len(set(hashes)) == 6
    values = np.random.default_rng(1).integers(0, 3, 400).astype(np.uint64)
    for length in (1, 2, 3, 5, 8, 35):
        found = window_hashes(values, length).tolist()
        plain = [tuple(values[k : k + length].tolist()) for k in range(400 - length + 1)]
        assert len(found) == len(plain)
        assert len(set(zip(found, plain, strict=True))) == len(set(found)) == len(set(plain))
    assert len(window_hashes(values[:3], 4)) == 0


def test_shingles():
    texts = ["a b c d e f", "A b", "", "b a", "a b c d e", "a b c"]
    ((_, _, part),) = slices(pa.array(texts))
    hashes, first = shingles(part, 5)
    sets = [hashes[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    assert [len(s) for s in sets] == [2, 1, 0, 1, 1, 1]
    assert sets[4][0] == sets[0][0]
    assert len({h for s in sets for h in s}) == 5


@pytest.mark.parametrize("weak", [False, True])
@pytest.mark.parametrize("kind", ["byte", "plain", "word", "piece"])
def test_encoder(monkeypatch, kind, weak):
    """Ids are the library's, also where different pieces share a hash or the memory is full."""
    texts = [t for t in TEXTS if t] + ["two  spaces ", " ", "  x", "wide　 space\r\n"]
    if weak:
        monkeypatch.setattr(pieces, "span_hashes", lambda d, a, b: (b - a).astype(np.uint64))
    else:
        monkeypatch.setattr(pieces, "MOST_PIECES", 7)
    path = {"word": WORD_BPE, "piece": PIECES}.get(kind, BYTE_BPE)
    encoder = PieceEncoder(path, kind)
    if kind == "piece":
        want = SentencePieceProcessor(model_file=path).encode(texts, num_threads=1)
        texts = [f" {t}" for t in texts]
    else:
        plain = Tokenizer.from_file(path)
        plain.no_truncation()
        plain.no_padding()
        plain.encode_special_tokens = kind == "plain"
        want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    got = []
    for _, _, part in slices(pa.array(texts), 2000):
        ids, first = encoder.encode(part)
        assert encoder.counts(part).tolist() == np.diff(first).tolist()
        got += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    assert got == want


def test_mirrored_texts_differ(docs):
    """Texts that a linear hash confuses are told apart by every operator that hashes words."""
    tokens = {r.doc_id: r.n_tokens for r in token_counts(docs, BYTE_BPE).collect()}
    plain = Tokenizer.from_file(BYTE_BPE)
    assert all(tokens[k] == len(plain.encode(t or "").ids) for k, t in enumerate(TEXTS))
    crcs = {r.doc_id: r.ids_crc32 for r in pack(docs, WORD_BPE, size=1 << 16).collect()}
    assert crcs[0] != crcs[1]
    verdicts = {r.doc_id: r for r in quality_verdicts(docs, None).collect()}
    assert verdicts[2].n_repeat_words == 0
    assert verdicts[5].n_dup_lines == 2
    windows = {r.doc_id: r.n_removed for r in drop_repeated_windows(docs).collect()}
    lists = {k: (t or "").split() for k, t in enumerate(TEXTS)}
    for k in (3, 4):
        places = {}
        for name, words in lists.items():
            for at in range(len(words) - 34):
                places.setdefault(tuple(words[at : at + 35]), []).append((name, at))
        gone = {w + at for v in places.values() if len(v) > 1 for n, at in v if n == k for w in range(35)}
        assert windows[k] == len(gone)
    groups = {r.doc_id: r.component_id for r in similar_groups(docs).collect()}
    assert groups[0] != groups[1]


def test_small_slices(spark, docs, monkeypatch):
    """The rows do not depend on how texts are cut into slices; code in tasks is this module's."""

    def rows(df):
        return sorted(map(repr, df.collect()))

    makes = [
        lambda: quality_verdicts(docs, None),
        lambda: token_counts(docs, BYTE_BPE),
        lambda: drop_repeated_windows(docs),
        lambda: similar_groups(docs),
    ]
    whole = [rows(make()) for make in makes]
    defaults = textbytes.slices.__defaults__
    textbytes.slices.__defaults__ = (1024, 3)
    try:
        assert [rows(make()) for make in makes] == whole
    finally:
        textbytes.slices.__defaults__ = defaults
