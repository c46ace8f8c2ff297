"""Cross-tokenizer alignment against plain Python."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from contactmine.llm import alignment
from contactmine.llm.alignment import align_tokenizers, pair_counts, pair_index

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", "The the THE unbelievable, naïve café.\n\nNew  line\ttab\r\n", "<|endoftext|> <s> </s> <0x0A>",
    "a▁b", "日本語 emoji 🎉🎉 mixed", "\x00 nul", "wide　space ​", *["common words of the text"] * 5, "the " * 400,
    " ".join(f"word{k % 37} other{k % 11}," for k in range(900)), "x" * 3000,
]
SCHEMA = "doc_id long, text string, number long, pair string, block int, n_links string"
ROWS = [(k, t, 5, "x", None, "y") for k, t in enumerate(TEXTS)] + [(None, "null id", 5, "", 1, None)] * 2


@pytest.fixture(scope="module", params=[2, 5])
def docs(spark, request):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(request.param)


def _plain(texts):
    """Groups of (A ids, B ids) per text, [] without tokens."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    byte = alignment.byte_level_characters()
    b = SentencePieceProcessor(model_file=B)
    out = []
    for text in texts:
        groups = []
        if text:
            whole = b" " + text.encode()
            ids_a, ids_b = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
            bytes_a = [bytes(byte[c] for c in a.id_to_token(k)) for k in ids_a]
            pieces = [(k, b.id_to_piece(k)) for k in ids_b]
            bytes_b = [
                bytes([int(p[1:-1], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode()
                for k, p in pieces
            ]
            if b"".join(bytes_a) == whole == b"".join(bytes_b):
                i = j = at_a = at_b = 0
                group = ([], [])
                while i < len(ids_a) or j < len(ids_b):
                    if at_a <= at_b:
                        group[0].append(ids_a[i])
                        at_a, i = at_a + len(bytes_a[i]), i + 1
                    else:
                        group[1].append(ids_b[j])
                        at_b, j = at_b + len(bytes_b[j]), j + 1
                    if at_a == at_b:
                        groups.append(group)
                        group = ([], [])
        out.append(groups)
    return out


def test_groups_of_one_text():
    (groups,) = _plain(["The cat"])
    assert all(a and b for a, b in groups)


@pytest.mark.parametrize("small", [False, True])
def test_alignment(docs, monkeypatch, small):
    if small:  # many blocks, bitmaps and lists
        monkeypatch.setattr(alignment, "POSTINGS", 10)
        monkeypatch.setattr(alignment, "_LIST", 2)
    groups = _plain([r[1] for r in ROWS])
    counts = Counter((a[-1], b[-1]) for gs in groups for a, b in gs)
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    want = Counter()
    for row, gs in zip(ROWS, groups, strict=True):
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        own = [(a[-1], b[-1]) for a, b in gs]
        want[
            row[0], sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), len(own),
            sum(counts[p] == highest[p[1]] for p in own), sum(counts[p] for p in own),
            hashlib.sha256(written.encode()).hexdigest() if gs else "",
        ] += 1
    df = align_tokenizers(docs, A, B)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, df.collect())) == want
    _, index, width = pair_index(docs, A, B)
    found = {(r.a, r.b): (r.n_docs, r.n_links) for r in pair_counts(index, width).collect()}
    docs_of = Counter(p for gs in groups for p in {(a[-1], b[-1]) for a, b in gs})
    assert found == {p: (docs_of[p], n) for p, n in counts.items()}


def test_empty(spark):
    assert align_tokenizers(spark.createDataFrame([], SCHEMA), A, B).count() == 0
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in align_tokenizers(one, A, B).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]
