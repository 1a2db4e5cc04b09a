"""Permutation index: footrule against its definition, recall and odd rows against brute force."""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from txrisk.llm import neighbours
from txrisk.llm.neighbours import Block, matrix, nearest, op11_neighbours, orders

SCHEMA = "vec_id long, embedding array<float>"


def dot(x, y):
    """Summed left to right; the built-in ``sum`` carries a correction along."""
    return reduce(add, (float(a) * float(b) for a, b in zip(x, y)), 0.0)


def brute(rows, n=20, each=20):
    """(query, rank, vec_id, score) by plain double sums over all rows."""
    out = []
    for q, x in rows:
        if q % each:
            continue
        scored = sorted((-dot(x, y), v) for v, y in rows if v != q)
        out += [(q, rank, v, -s) for rank, (s, v) in enumerate(scored[:n], 1)]
    return sorted(out)


def f32(x):
    return [float(v) for v in np.asarray(x, dtype=np.float32)]


def test_footrule_saved_is_that_of_the_orders():
    rng = np.random.default_rng(1)
    x, pivots, k = rng.normal(size=(40, 8)), rng.normal(size=(12, 9)), 5
    q = rng.normal(size=(6, 8))
    block = Block(np.arange(40), x, pivots, k, 10.0)
    saved = np.array(list(block.footrule_saved(q)))
    mine = orders(q, np.zeros(6), pivots, k)
    theirs = orders(x, neighbours.lift(x, 10.0), pivots, k)
    place = lambda order, p: list(order).index(p) if p in order else k
    for i in range(6):
        for j in range(40):
            footrule = sum(abs(place(mine[i], p) - place(theirs[j], p)) for p in range(12))
            assert footrule == k * (k + 1) - 2 * saved[i, j]


def test_matrix_fills_up_short_vectors():
    import pyarrow as pa

    col = pa.array([[1.0, 2.0], [3.0], [4.0, 5.0]], pa.list_(pa.float32()))
    assert matrix(col, 3).tolist() == [[1, 2, 0], [3, 0, 0], [4, 5, 0]]
    assert matrix(col.slice(1), 2).tolist() == [[3, 0], [4, 5]]


def test_recall_on_the_given_table(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    want = brute([(r.vec_id, r.embedding) for r in table])
    got = op11_neighbours(spark, SMALL).collect()
    assert {(r.query_id, r["rank"]) for r in got} == {(q, k) for q, k, _, _ in want}
    near = {(q, v): s for q, _, v, s in brute([(r.vec_id, r.embedding) for r in table], n=len(table))}
    hits = {(q, v) for q, _, v, _ in want} & {(r.query_id, r.vec_id) for r in got}
    assert len(hits) >= 0.9 * len(want)
    assert all(r.score == near[r.query_id, r.vec_id] for r in got)
    by_query = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by_query.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert all(v == sorted(v) for v in by_query.values())


def test_recall_with_unequal_lengths_and_a_hot_group(spark):
    """A third of the rows are one vector, a third near copies of another, lengths differ."""
    rng = np.random.default_rng(2)
    hot, near = rng.normal(size=16), rng.normal(size=16)
    x = [hot] * 400 + [near + 0.01 * rng.normal(size=16) for _ in range(400)] + [rng.normal(size=16) * rng.uniform(0.5, 2) for _ in range(400)]
    rows = [(i, f32(v)) for i, v in enumerate(x)]
    want = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    got = nearest(df, df.filter("vec_id % 20 = 0")).collect()
    assert len(got) == len(want)
    hits = {(q, v) for q, _, v, _ in want} & {(r.query_id, r.vec_id) for r in got}
    assert len(hits) >= 0.9 * len(want)
    # equal vectors have equal scores and are ranked by id
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 0), key=lambda r: r["rank"])] == [v for q, _, v, _ in want if q == 0]


def test_queries_that_find_too_few_are_searched_over_all_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, f32(v)) for i, v in enumerate(rng.normal(size=(200, 8)))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = nearest(df, df.filter("vec_id % 20 = 0"), farthest=0.01)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


@pytest.mark.parametrize("extra", [False, True])
def test_odd_rows(spark, extra):
    nan, inf = float("nan"), float("inf")
    fine = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0]), (3, [3.0]), (20, [0.0, 1.0])]
    odd = [(40, None), (60, []), (80, [0.0, 0.0]), (100, [nan, 1.0]), (120, [inf, 1.0]), (140, [None, 1.0]), (None, [1.0, 1.0]),
           (1, [0.5, 0.5]), (3, [2.0, 9.0]), (5, [0.25, 0.25]), (5, [0.125, 9.0])]
    df = spark.createDataFrame(fine + odd, SCHEMA)
    if extra:
        df = df.withColumns({c: F.lit("clash") for c in ("id", "x", "h", "block", "asked", "score", "rank", "query_id", "n")})
    got = sorted(tuple(r) for r in nearest(df, df.filter("vec_id % 20 = 0")).collect())
    # of several rows with one id the largest vector counts; short vectors are filled up
    plain = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0]), (3, [3.0, 0.0]), (5, [0.25, 0.25]), (20, [0.0, 1.0])]
    assert got == brute(plain)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(0, [1.0])], SCHEMA)
    for base, queries in ((none, none), (some, none), (none, some), (some, some)):
        got = nearest(base, queries)
        assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.count() == 0
