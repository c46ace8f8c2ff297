"""The quality classifier against plain formulas and on held-out labels."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from contactmine.llm import textbytes
from contactmine.llm.discriminant import (
    STATISTICS,
    class_sums,
    document_statistics,
    fit,
    fit_discriminant,
    score_quality,
    transformed_statistics,
)

SCHEMA = "doc_id long, text string, score double, label string, kept int"


def _statistics(texts):
    return np.concatenate([transformed_statistics(part) for _, _, part in textbytes.slices(pa.array(texts, pa.string()))])


def test_statistics():
    share = lambda a, b: np.arcsin(np.sqrt(a / b))
    (row,) = _statistics(["Ab cd cd\n\nab, 12 #x\nab, 12 #x"])
    want = [
        np.log1p(9), np.log1p(20 / 9), np.log1p(np.sqrt(46 / 9 - (20 / 9) ** 2)), share(1, 20), share(4, 20),
        share(2, 20), share(2, 20), share(5, 9), share(1, 7), share(1, 3), np.log1p(3), share(9, 9), np.log1p(3),
    ]
    assert np.allclose(row, want)
    assert np.isfinite(_statistics(["", None, " \n ", "é" * 5000, "a"])).all()
    assert len(row) == len(STATISTICS)


def test_density():
    """Log-density differences of the fitted covariances, written out."""
    rng = np.random.default_rng(3)
    x = [rng.normal(0, 1, (300, 4)), rng.normal(1, [1, 2, 0.5, 1], (500, 4))]
    x[1][:, 3] = 7  # a constant within its class
    sums = np.stack([np.column_stack([np.ones(len(v)), v]).T @ np.column_stack([np.ones(len(v)), v]) for v in x])
    shrink, ridge, temper = 0.3, 0.02, 2.0
    model = fit(sums, shrink, ridge, temper)
    both = np.concatenate(x)
    z = [(v - both.mean(0)) / both.std(0) for v in x]
    cov = [np.cov(v.T, bias=True) for v in z]
    pooled = (300 * cov[0] + 500 * cov[1]) / 800
    out = []
    for v, c in zip(z, cov, strict=True):
        own = (1 - shrink) * c + shrink * pooled
        own = (1 - ridge) * own + ridge * np.trace(own) / 4 * np.eye(4)
        off = (both - both.mean(0)) / both.std(0) - v.mean(0)
        out.append(-0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(own), off) - 0.5 * np.linalg.slogdet(own)[1])
    want = (out[1] - out[0]) / temper + np.log(5 / 3)
    assert np.allclose(model.logits(both), want)
    assert fit(np.zeros((2, 5, 5))) is None


def test_sums(spark, sf_dir):
    """Every labelled row that is not held out counts, once for each row of its id."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.union(labels.limit(5)).union(spark.createDataFrame([(None, 1, 0), (10**9, 1, 0)], labels.schema))
    known = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    rows = [(r.text, known[r.doc_id]) for r in docs.collect()
            if r.doc_id in known and zlib.crc32(str(r.doc_id).encode()) % 5 != 0]
    x = np.column_stack([np.ones(len(rows)), _statistics([t for t, _ in rows])])
    y = np.array([k for _, k in rows])
    found = np.zeros((2, x.shape[1] ** 2))
    for r in class_sums(document_statistics(docs.repartition(3)), labels).collect():
        found[r.label, r.place] = float(r.value)
    for k in (0, 1):
        assert np.allclose(found[k].reshape(x.shape[1], -1), x[y == k].T @ x[y == k])


def test_scores(spark, sf_dir):
    base = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    table = document_statistics(docs)
    model = fit_discriminant(table, labels)
    df = score_quality(table, model)
    assert df.columns == ["doc_id", "held_out", "score", "predicted"]
    got = {r.doc_id: r for r in df.collect()}
    assert len(got) == docs.count()
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    good = [s.predicted for q, s in held if q == 1]
    bad = [1 - s.predicted for q, s in held if q == 0]
    assert np.mean(good) >= 0.95 and np.mean(bad) >= 0.9
    # Other columns never count.
    changed = docs.selectExpr("doc_id", "text", "'x' AS lang", "'y' AS source")
    assert {r.doc_id: r.score for r in score_quality(document_statistics(changed), model).collect()} == {k: r.score for k, r in got.items()}


@pytest.mark.parametrize("parts", [1, 4])
def test_hostile_rows(spark, parts):
    rows = [(1, None, 0.5, "x", 1), (None, "a b", None, None, None), (2, "", 1.0, "", 0), (2, "", 1.0, "", 0), (3, "w " * 90_000, 0.0, "y", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, None)], "doc_id long, quality int")
    table = document_statistics(docs)
    model = fit_discriminant(table, labels)
    for m in (model, None):
        got = score_quality(table, m).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
        assert not any(r.held_out for r in got if r.doc_id is None)
    none = document_statistics(spark.createDataFrame([], SCHEMA))
    assert score_quality(none, None).count() == 0
    assert fit_discriminant(none, labels) is None
