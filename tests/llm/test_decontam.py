"""Windows against brute force, in one block and in several."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from tests.conftest import SMALL
from tests.llm.helpers import docs, odd_rows, with_clashes
from txrisk.llm import decontam

ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve"),
    (2, "short item"),
    (3, "lone"),
    (4, "One two three four five six seven eight nine ten, eleven TWELVE"),
    (5, "the " * 15),
    (6, ""),
    (7, None),
    (8, "!!"),
    (9, "été naïve 日本 one two"),
    (None, "an item without an id but with words"),
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(text, items):
    w = words(text)
    hit, found = set(), set()
    for i, t in items:
        iw = words(t)
        if i is None or not iw:
            continue
        k = min(10, len(iw))
        windows = {tuple(iw[p : p + k]) for p in range(len(iw) - k + 1)}
        for p in range(len(w) - k + 1):
            if tuple(w[p : p + k]) in windows:
                hit |= set(range(p, p + k))
                found.add(str(i))
    return len(w), len(hit), sorted(found)


def random_docs():
    rnd = random.Random(4)
    pool = [w for _, t in ITEMS for w in words(t)] + ["other", "text"]
    out = []
    for i in range(60):
        text = " ".join(rnd.choice(pool) for _ in range(rnd.randint(0, 30)))
        piece = rnd.choice(ITEMS[:5])[1]
        out.append((100 + i, text + (". " + piece.upper() if i % 2 else "") + " " + text[::-1]))
    return out


@pytest.mark.parametrize("block", [400_000, 3])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block)
    rows = random_docs() + odd_rows("the") + [(50, "lone"), (51, "the " * 25)]
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, t string")
    out = decontam.contaminated(with_clashes(docs(spark, rows)), items, ["doc_id", "text", "spans"], prefix="b_").collect()
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id == 4:
            assert sum(s.end - s.start for s in r.b_spans) == 30_000 and r["b_items"] == ["5"]
            continue
        n, hit, found = brute(r.text, ITEMS)
        assert (r.b_n_words, sum(s.end - s.start for s in r.b_spans), r["b_items"]) == (n, hit, found), r.text


def test_empty_tables(spark):
    items = spark.createDataFrame([(i, t) for i, t in ITEMS], "item_id long, text string")
    assert decontam.contaminated(docs(spark, []), items, ["doc_id"]).count() == 0
    out = decontam.contaminated(docs(spark, [(1, "one two")]), items.limit(0), ["doc_id"]).collect()
    assert [(r.doc_id, r.n_words, r.spans, r["items"]) for r in out] == [(1, 2, [], [])]


def test_query_and_stage(spark):
    got = {r.doc_id: r for r in decontam.op9_decontamination(spark, SMALL).collect()}
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = table.collect()
    assert len(got) == len(rows)
    for r in rows[::5] + [r for r in rows if got[r.doc_id].contaminated]:
        n, hit, found = brute(r.text, items)
        g = got[r.doc_id]
        assert (g.n_words, g.n_hit, g.n_items, g.contaminated) == (n, hit, len(found), hit > 0)
        assert g.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
    kept = decontam.stage_decontamination(spark, table, SMALL)
    assert kept.columns == table.columns and kept.count() == sum(not g.contaminated for g in got.values())


def test_a_benchmark_of_many_blocks_is_dealt_by_parts_and_one_at_a_time(spark, monkeypatch):
    """One id holds nearly all words, in one long item and in many rows: no block holds more than its share."""
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 2_000)
    monkeypatch.setattr(decontam, "PART_WINDOWS", 100)
    long = " ".join(f"w{i:05d}" for i in range(4_000))
    items = [(1, long)] + [(1, " ".join(f"r{k:02d}x{i:02d}" for i in range(20))) for k in range(50)] + [(2, "a b c"), (3, long)]
    import gc
    import weakref

    words, alive, most = [], [], []
    build = decontam.build_index

    def counted(rows):
        gc.collect()
        most.append(sum(x() is not None for x in alive))
        words.append(sum(len(t.split()) for _, t in rows))
        index = build(rows)
        alive.append(weakref.ref(index))
        return index

    monkeypatch.setattr(decontam, "build_index", counted)
    text = " ".join(f"w{i:05d}" for i in range(95, 215))
    rows = [(1, "see " + text + " so"), (2, "x " + items[7][1] + " a b c"), (3, "nothing here"), (4, None)] + [(10 + i, "see " + text + " so") for i in range(50)]
    out = {r.doc_id: r for r in decontam.contaminated(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"]).collect()}
    assert len(words) > 3 and max(words) < 6_000 and max(most) <= 2
    for i in [1, *range(10, 60)]:
        assert ([(s.start, s.end) for s in out[i].spans], out[i]["items"], out[i].n_words) == ([(1, 121)], ["1", "3"], 122)
    assert ([(s.start, s.end) for s in out[2].spans], out[2]["items"]) == ([(1, 24)], ["1", "2"])
    assert not out[3].spans and not out[4].spans and out[4].n_words == 0
