"""Near-duplicates and components against brute force."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.helpers import docs, odd_rows, with_clashes
from txrisk.llm import dedup
from txrisk.llm.components import components


def roots(n, edges):
    low = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def shingles(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace(" ", "_").split()]
    if not words:
        return set()
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows):
    """{row number: (set size, component's smallest id)}"""
    sets = [shingles(t) for _, t in rows]
    edges = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    low = roots(len(rows), edges)
    return [(len(sets[i]), min(rows[j][0] for j in range(len(rows)) if low[j] == low[i])) for i in range(len(rows))]


def families(seed, groups=12, copies=14, words=60):
    """Groups of texts that differ from their first one in more and more places; some chains."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(4))
    out = []
    for g in range(groups):
        base = [word() for _ in range(words)]
        for c in range(copies):
            own = list(base)
            for _ in range(rnd.randint(0, 4)):
                own[rnd.randrange(words)] = word()
            out.append(" ".join(own))
            if g % 3 == 0:
                base = own  # a chain: each copy is made from the last
    rnd.shuffle(out)
    return [(i + 1, t) for i, t in enumerate(out)]


def test_components_equal_union_find(spark):
    rnd = random.Random(2)
    for n, m in ((1, 0), (40, 25), (60, 59)):
        edges = [(i, i + 1) for i in range(n - 1)] if m == n - 1 else [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)]
        got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u int, v int")).collect()}
        assert [got.get(i, i) for i in range(n)] == roots(n, edges)


def test_families_equal_brute_force(spark):
    rows = families(1) + [(1000 + i, t) for i, t in enumerate(["", "one", "one", "One two", "one  two\n", "a b c d", "a b c e"])]
    got = {r.doc_id: r for r in dedup.near_duplicates(docs(spark, rows)).collect()}
    for (i, _), (size, smallest) in zip(rows, brute(rows)):
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (size, smallest, smallest == i), i


def test_odd_rows(spark):
    rows = odd_rows() + [(20, "a row without an id"), (6, "another text under a used id")]
    out = dedup.near_duplicates(with_clashes(docs(spark, rows))).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert all(r.component_id == i and r.kept for i in (1, 2, 3, 4, 5, 6, 7, 20) for r in by[i])
    assert by[None][0].component_id == 20 and not by[None][0].kept
    assert [r.n_shingles for r in by[1] + by[2] + by[3]] == [0, 0, 0] and by[4][0].n_shingles == 1
    kept = dedup.stage_dedup(spark, with_clashes(docs(spark, rows)), SMALL)
    assert kept.filter("doc_id = 6").count() == 2 and kept.filter("doc_id is null").count() == 0
    assert dedup.near_duplicates(docs(spark, [])).count() == 0


def test_estimate_follows_similarity(spark):
    rng = np.random.default_rng(4)
    pairs = []
    for j in (0.0, 0.3, 0.6, 0.75, 0.9, 1.0):
        both, own = int(400 * j), 400 - int(400 * j)
        x = rng.integers(0, 2**63, both + own, np.uint64)
        a, b = x[: both + own // 2], np.concatenate([x[:both], x[both + own // 2 :]])
        m = [dedup.packed(dedup.minima(s)[None])[0].tolist() for s in (a, b)]
        pairs.append((j, m[0], m[1]))
    df = spark.createDataFrame(pairs, "j double, asig array<long>, bsig array<long>")
    for r in df.select("j", dedup.estimate("asig", "bsig").alias("e")).collect():
        assert abs(r.e - r.j) < 0.08, r


def test_pairs_of_a_copied_group_stay_few(spark):
    """300 near copies of one text, each its own set: far fewer tests than pairs."""
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(300):
        own = list(base)
        own[rnd.randrange(400)] = f"x{i}"
        rows.append((i, " ".join(own)))
    seen = []
    inner = dedup.links

    def spy(d, t, n, candidates, within):
        seen.append(candidates.count())
        return inner(d, t, n, candidates, within)

    dedup.links = spy
    try:
        out = dedup.near_duplicates(docs(spark, rows))
    finally:
        dedup.links = inner
    assert out.filter(F.col("component_id") != 0).count() == 0
    assert sum(seen) < 300 * 40 and seen[-1] == 0


def test_stage_decides_by_row_where_ids_repeat_or_are_null(spark):
    def words(name, n=60):
        return " ".join(f"{name}{i}" for i in range(n))

    a, b, c = words("a"), words("b"), words("c")
    rows = [
        (1, a), (1, a + " more"),  # near-equal under one id: one stays
        (2, a + " extra"), (2, b),  # the first is a copy of 1, the second its own
        (None, c), (None, c + " more"), (None, words("d")), (None, a + " end"),  # of c one, d, and no copy of a
        (3, c + " z"),  # has an id, so it stays for c
        (None, words("e")), (None, words("e") + " more"),
        (4, b + " more"),
    ]
    kept = [(r.doc_id, r.text) for r in dedup.stage_dedup(spark, docs(spark, rows), SMALL).collect()]
    groups = sorted((i or 0, t.split()[0]) for i, t in kept)
    assert groups == [(0, "d0"), (0, "e0"), (1, "a0"), (2, "b0"), (3, "c0")]


def site(rnd, pages, same=57, own=17):
    """Pages of one template, alike at about 0.55: most words in common, each its own in one stretch."""
    head, tail = [f"h{i}" for i in range(same // 2)], [f"t{i}" for i in range(same - same // 2)]
    return [" ".join(head + [f"p{rnd.randrange(10**9)}" for _ in range(own)] + tail) for _ in range(pages)]


def test_pages_of_a_template_make_no_pairs(spark, monkeypatch):
    """Unlinked pages share buckets but no rare shingle; copies among them are found all the same."""
    rnd = random.Random(3)
    texts = site(rnd, 300)
    for i in range(0, 60, 3):  # a page again with a word more, and again with two
        texts += [texts[i] + " more", texts[i] + " more still"]
    rows = list(enumerate(texts, 1))
    rnd.shuffle(rows)
    seen = []
    inner = dedup.prefix_pairs
    monkeypatch.setattr(dedup, "prefix_pairs", lambda *a: seen.append(inner(*a)) or seen[-1].persist())
    monkeypatch.setattr(dedup, "GROUP_ROWS", 7)
    counts = []
    links = dedup.links
    monkeypatch.setattr(dedup, "links", lambda d, t, n, c, w: counts.append(c.count()) or links(d, t, n, c, w))
    got = {r.doc_id: r for r in dedup.near_duplicates(docs(spark, rows)).collect()}
    for (i, _), (size, smallest) in zip(rows, brute(rows)):
        assert (got[i].n_shingles, got[i].component_id) == (size, smallest), i
    assert len(seen) == 1 and counts[-1] <= 200


def test_prefixes_of_linked_sets_meet():
    """For any counts: the larger set's prefix meets the smaller one's shorter prefix."""
    rng = np.random.default_rng(6)
    for _ in range(3000):
        n = int(rng.integers(1, 60))
        x = rng.choice(10**6, n, replace=False).astype(np.uint64)
        keep = x[rng.random(n) < 0.9]
        y = np.unique(np.concatenate([keep, rng.integers(10**6, 2 * 10**6, int(rng.integers(0, n // 5 + 1))).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if not len(y) or 100 * both < 75 * (len(x) + len(y) - both):
            continue
        x, y = sorted((x, y), key=len, reverse=True)
        counts = rng.integers(0, 4, dedup.COUNTERS)
        low = len(y) - -(-150 * len(y) // 175) + 1
        assert np.intersect1d(dedup.prefix(x, counts), dedup.prefix(y, counts)[:low]).size


def test_nothing_but_the_result_stays_in_the_shared_folder(spark):
    import os

    place = dedup.folder(spark)
    before = set(os.listdir(place)) if os.path.isdir(place) else set()
    dedup.near_duplicates(docs(spark, families(2, groups=2))).count()
    assert [n.rsplit("-", 1)[0] for n in set(os.listdir(place)) - before] == ["near-duplicates"]
