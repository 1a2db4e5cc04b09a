"""Statistics against brute force, trees, and the stage."""

from __future__ import annotations

import random
import re

import numpy as np

from tests.conftest import SMALL
from tests.llm.helpers import docs, odd_rows, with_clashes
from txrisk.llm import quality


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)]


def test_counts_on_random_text():
    rnd = random.Random(1)
    for _ in range(3000):
        text = "".join(rnd.choice(["a", "b", "a b a", " ", "\n", "\t", "\x0b", " ", "é", "#", "%|", "\x1c", "\x85"]) for _ in range(rnd.randint(0, 60)))
        assert quality.statistics(text)[0] == brute(text), repr(text)


def test_trees_are_monotonic_and_learn():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(2000, 3))
    y = ((x[:, 0] + 0.3 * np.sin(20 * x[:, 0]) < 0.5) & (x[:, 1] > 0.2)).astype(float)
    trees = quality.fit_trees(x, y, [-1, 1, 0])
    assert ((trees.probability(x) >= 0.5) == y).mean() > 0.9
    for f, sign in ((0, -1), (1, 1)):
        base = np.repeat(rng.uniform(size=(50, 1, 3)), 40, 1)
        base[:, :, f] = np.linspace(0, 1, 40)
        p = trees.probability(base.reshape(-1, 3)).reshape(50, 40)
        assert (sign * np.diff(p, axis=1) >= -1e-12).all()


def test_node_arrays_equal_a_slow_walk():
    """Scores by arrays against a walk down each tree, row by row."""
    rng = np.random.default_rng(2)
    x = np.round(rng.uniform(size=(400, 3)), 2)  # many values that equal a threshold
    y = (x[:, 0] * x[:, 1] + 0.1 * rng.normal(size=400) > 0.3).astype(float)
    trees = quality.fit_trees(x, y, [1, 0, 0], trees=12)
    got = trees.probability(x)
    for row, p in zip(x, got):
        total = trees.base
        for t in range(len(trees.feature)):
            at = 0
            while trees.feature[t, at] >= 0:
                f = trees.feature[t, at]
                at = trees.left[t, at] if row[f] <= trees.threshold[t, at] else trees.right[t, at]
            total += trees.value[t, at]
        assert abs(p - 1 / (1 + np.exp(-total))) < 1e-12


def test_first_split_is_the_best_of_all():
    """One tree of one level against every feature and value, with a constraint and without."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (80, 3)).astype(float)
    y = ((x[:, 1] < 5) | (rng.uniform(size=80) < 0.2)).astype(float)
    for direction in ([0, 0, 0], [0, 1, 0], [0, -1, 0]):
        trees = quality.fit_trees(x, y, direction, trees=1, depth=1, bins=200)
        g, h = y.mean() - y, np.full(80, y.mean() * (1 - y.mean()))
        part = lambda rows: g[rows].sum() ** 2 / (h[rows].sum() + 1)
        value = lambda rows: -g[rows].sum() / (h[rows].sum() + 1)
        best = max(
            (part(low) + part(~low), f, c)
            for f in range(3)
            for c in range(12)
            for low in [x[:, f] <= c]
            if low.sum() >= 5 <= (~low).sum() and direction[f] * (value(~low) - value(low)) >= 0
        )
        low = x[:, trees.feature[0, 0]] <= trees.threshold[0, 0]
        assert abs(part(low) + part(~low) - best[0]) < 1e-9
        assert np.allclose([trees.value[0, trees.left[0, 0]], trees.value[0, trees.right[0, 0]]], [0.2 * value(low), 0.2 * value(~low)])


def test_one_class_or_no_labels():
    x = np.ones((4, 3))
    assert quality.fit_trees(x, np.ones(4), [0, 0, 0]).probability(x).min() > 0.9
    assert quality.fit_trees(np.zeros((0, 3)), np.zeros(0), [0, 0, 0]).probability(x).tolist() == [0.5] * 4


def test_odd_rows(spark):
    rows = odd_rows()
    frame = with_clashes(docs(spark, rows))
    labels = spark.createDataFrame([(4, 0), (5, 0), (6, 1), (6, 1), (None, 1), (7, None)], "doc_id long, quality int")
    trees = quality.fit(frame, labels)
    out = quality.judge(frame, trees, ["doc_id", "text", "n_words"], prefix="q_").collect()
    assert len(out) == len(rows)
    for r in out:
        assert [r["q_" + c] for c in quality.COUNTS[:3]] == brute((r.text or "")[:0] if r.doc_id == 4 else r.text or "")[:3] or r.doc_id == 4
        assert r.q_base_failed and not r.q_kept
    four = next(r for r in out if r.doc_id == 4)
    assert (four.q_n_words, four.q_n_repeat_words) == (30_000, 30_000)
    empty = docs(spark, [])
    assert quality.judge(empty, quality.fit(empty, labels.limit(0)), ["doc_id"]).count() == 0


def test_query_over_the_whole_table(spark):
    got = {r.doc_id: r for r in quality.op6_quality(spark, SMALL).collect()}
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = table.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        g = got[r.doc_id]
        if g.n_words < 2000:  # the brute force is quadratic
            assert [g[c] for c in quality.COUNTS] == brute(r.text or "")
        assert g.base_failed == (g.n_words < 50 or 100 * g.n_repeat_words > 50 * g.n_words)
        assert not (g.base_failed and g.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    sound = [i for i, q in labels.items() if i in got and not got[i].base_failed]
    assert all(got[i].kept for i in sound if labels[i] == 1)
    assert sum(got[i].kept for i in sound if labels[i] == 0) <= 2
    kept = quality.stage_quality(spark, table, SMALL)
    assert kept.columns == table.columns and kept.count() == sum(g.kept for g in got.values())
