"""The risk estimator, and held-out results."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import docs, odd_rows, with_clashes
from txrisk.llm import toxicity


def test_risk_separates_from_positives_and_unlabelled():
    rng = np.random.default_rng(0)
    make = lambda n, toxic: (rng.uniform(size=(n, 20)) < np.where(np.arange(20) < 10, 0.4 if toxic else 0.02, 0.3)).astype(np.float32)
    xp, xu = make(300, True), np.concatenate([make(100, True), make(900, False)])
    w, b = toxicity.fit_pu(xp, xu, 0.1)
    score = lambda x: 1 / (1 + np.exp(-(x @ w + b)))
    pos, neg = score(make(2000, True)), score(make(2000, False))
    assert (pos[:, None] > neg[None, :500]).mean() > 0.97
    assert (neg >= 0.7).mean() < 0.01 < (pos >= 0.7).mean()


def test_fit_follows_the_stated_risk():
    """Against a plain version: the risk row by row, its slope by differences, the same steps."""
    rng = np.random.default_rng(5)
    xp, xu = rng.uniform(size=(12, 4)), rng.uniform(size=(20, 4)) + 0.3
    xp[:, 0] += 1.0
    loss = lambda z: float(np.log1p(np.exp(-z)))

    def terms(v, prior):
        z = lambda row: sum(a * c for a, c in zip(row, v)) + v[4]
        positive = prior * sum(loss(z(r)) for r in xp) / len(xp)
        negative = sum(loss(-z(r)) for r in xu) / len(xu) - prior * sum(loss(-z(r)) for r in xp) / len(xp)
        return positive, negative

    for prior, steps in ((0.2, 12), (0.7, 60)):
        v, m, q, signs = np.append(np.zeros(4), np.log(prior / (1 - prior))), np.zeros(5), np.zeros(5), set()
        for t in range(1, steps + 1):
            up = terms(v, prior)[1] >= 0
            signs.add(up)
            risk = (lambda u: sum(terms(u, prior))) if up else (lambda u: -terms(u, prior)[1])
            g = np.array([(risk(v + e) - risk(v - e)) / 2e-5 for e in np.eye(5) * 1e-5]) + 1e-4 * np.append(v[:4], 0)
            m, q = 0.9 * m + 0.1 * g, 0.999 * q + 0.001 * g * g
            v = v - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(q / (1 - 0.999**t)) + 1e-8)
        w, b = toxicity.fit_pu(xp, xu, prior, steps)
        assert np.abs(np.append(w, b) - v).max() < 2e-3
    assert signs == {True, False}


def test_stems_are_shared_by_inflected_forms():
    a, b = (set(toxicity.word_hashes(t).tolist()) for t in ("walkings", "walkinge"))
    assert len(a & b) == 3 and len(toxicity.word_hashes("")) == 0


def test_odd_rows(spark):
    rows = odd_rows() + [(100 + i, f"awful clownish thing {i}" if i % 3 == 0 else f"plain thing {i}") for i in range(90)]
    frame = with_clashes(docs(spark, rows))
    labels = spark.createDataFrame([(100 + i, int(i % 3 == 0)) for i in range(60)] + [(None, 1), (6, None)], "doc_id long, toxic int")
    model = toxicity.fit(frame, labels, F.lit(True))
    out = toxicity.score(frame, model, ["doc_id", "text", "p"]).collect()
    assert len(out) == len(rows)
    assert all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r.score for r in out}
    assert min(by[100 + i] for i in range(60, 90, 3)) > max(by[101 + i] for i in range(60, 90, 3))
    assert by[1] == by[2] == by[3]
    nothing = toxicity.fit(frame, labels.limit(0), F.lit(True))
    assert {r.score for r in toxicity.score(frame, nothing, ["doc_id"]).collect()} == {0.0}
    assert toxicity.score(frame.limit(0), model, ["doc_id"]).count() == 0


def test_held_out_results(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = toxicity.op8_toxicity(spark, sf).collect()
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    held = [(r.predicted, labels[r.doc_id]) for r in out if r.held_out and r.doc_id in labels]
    caught = [p for p, y in held if y == 1]
    clean = [p for p, y in held if y == 0]
    # some 300 positives to learn from; with 1,400 it is 0.99 and 0.00
    assert len(caught) > 50 and np.mean(caught) > 0.9 and np.mean(clean) < 0.03
