"""Codebooks with bounds against plain rounds."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from txrisk.llm import codes
from txrisk.llm.codes import assign, compress, net_moves, op12_codes, squared

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=8, entries=16, rounds=6):
    """{vec_id: (code, error)} and the codebooks, with Python integers only."""
    rows = sorted(((v, [int(np.floor(4096 * float(c))) for c in x]) for v, x in rows))
    w = len(rows[0][1]) // parts
    cut = [(v, [x[p * w:(p + 1) * w] for p in range(parts)]) for v, x in rows]
    books = [[list(x[p]) for _, x in cut[:entries]] for p in range(parts)]
    near = lambda part, book: min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            took = defaultdict(list)
            for _, x in cut:
                took[near(x[p], books[p])[1]].append(x[p])
            for e, own in took.items():
                books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    out = {}
    for v, x in cut:
        best = [near(x[p], books[p]) for p in range(parts)]
        out[v] = ("".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best))
    return out, books


def some_rows(n, dims=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    return [(i, [float(v) for v in (centres[i % 6] + 0.3 * rng.normal(size=dims)).astype(np.float32)], i % 3) for i in range(n)]


def test_bounds_give_the_plain_assignment_and_spare_scans():
    rng = np.random.default_rng(4)
    x = rng.integers(-3000, 3000, size=(500, 4, 2))
    history, state, scans = [x[:8].transpose(1, 0, 2).copy()], None, []
    for _ in range(12):
        state, scanned = assign(x, state, history)
        scans.append(scanned)
        entry = state["entry"]
        for p in range(4):
            assert (entry[:, p] == squared(x[:, p], history[-1][p]).argmin(axis=1)).all()
        new = history[-1].copy()
        for p in range(4):
            for e in range(8):
                own = x[entry[:, p] == e, p]
                if len(own):
                    new[p, e] = own.sum(axis=0) // len(own)
        history.append(new)
    assert scans[0] == 2000 and scans[-1] < 600


def test_net_displacement_is_tighter_than_summed_drifts():
    to, fro = np.array([[[0, 0]]]), np.array([[[30, 40]]])
    moved, _ = net_moves([to, fro, to])
    assert moved[0, 0, 0] == 0 and moved[1, 0, 0] == 50  # drifts would add up to 100


def test_stale_bounds_hold_after_net_displacement():
    """Every kept bound, carried to the newest round, encloses the true distances."""
    rng = np.random.default_rng(5)
    x = rng.integers(-2000, 2000, size=(200, 2, 3))
    history, state = [x[:6].transpose(1, 0, 2).copy()], None
    for _ in range(8):
        state, _ = assign(x, state, history)
        moved, others = net_moves(history)
        for p in range(2):
            d = np.sqrt(squared(x[:, p], history[-1][p]).astype(float))
            own = state["entry"][:, p]
            i = np.arange(200)
            upper = state["upper"][:, p] + moved[state["upper_at"][:, p], p, own]
            lower = state["lower"][:, p] - others[state["lower_at"][:, p], p, own]
            rest = d.copy()
            rest[i, own] = np.inf
            assert (upper >= d[i, own] - 1e-6).all() and (lower <= rest.min(axis=1) + 1e-6).all()
        history.append(history[-1] + rng.integers(-300, 300, size=history[-1].shape))


def test_equals_plain_rounds(spark):
    rows = some_rows(300)
    table, books = compress(spark.createDataFrame(rows, SCHEMA).repartition(5))
    want, want_books = plain([r[:2] for r in rows])
    assert {r.vec_id: (r.code, r.error) for r in table.collect()} == want
    assert books.tolist() == want_books


def test_odd_rows(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    odd = [(1000, None, 1), (1001, [nan] * 16, 1), (1002, [inf] * 16, 2), (1003, [None] + [0.0] * 15, 2)]
    rows = [(v, x, None if v % 4 == 0 else lab) for v, x, lab in some_rows(60)]
    kept = rows + [(70, rows[3][1], 1), (70, rows[3][1], 1), (71, [], 2), (72, [0.5], 2), (73, [2.0e4] * 16, 2)]
    df = spark.createDataFrame(kept + [(None, rows[5][1], 1)] + odd, SCHEMA)
    df = df.withColumns({c: F.lit("clash") for c in ("x", "bounds", "code", "error", "sums", "k", "key", "_salt", "slot", "v")})
    monkeypatch.setattr(codes, "read", lambda *a: df)
    got = op12_codes(spark, "").collect()
    full = [(v, list(x) + [0.0] * (16 - len(x))) for v, x, _ in kept]
    want, books = plain(sorted(full, key=lambda r: r[0]) + [(10**9, rows[5][1])])
    assert sorted((r.vec_id if r.vec_id is not None else 10**9, r.code, r.error) for r in got) == sorted(
        [(v, *want[v]) for v, _ in full] + [(10**9, *want[10**9])])
    per = defaultdict(int)
    for v, _, lab in kept + [(10**9, None, 1)]:
        per[lab] += want[v][1]
    label = {v: lab for v, _, lab in kept} | {None: 1}
    assert all(r.label_error == per[label[r.vec_id]] for r in got)
    digest = hashlib.sha256(",".join(str(c) for p in books for e in p for c in e).encode()).hexdigest()
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_few_rows_and_huge_components(spark):
    table, books = compress(spark.createDataFrame([(1, [1.0] * 8, 0), (2, [3.0e38] * 8, 0)], SCHEMA))
    assert sorted((r.vec_id, r.code, r.error) for r in table.collect()) == [(1, "00" * 8, 0), (2, "01" * 8, 0)]
    assert books.shape == (8, 2, 1)


def test_empty_table(spark, monkeypatch):
    monkeypatch.setattr(codes, "read", lambda *a: spark.createDataFrame([(1, None, 1)], SCHEMA))
    got = op12_codes(spark, "")
    assert got.count() == 0 and got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
