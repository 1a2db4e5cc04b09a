"""Benchmark decontamination by a prefix-filtered join of word windows.

An item's windows are its runs of ten words. A document can hold a window only
where it holds the window's rarest shingle (three words), rarity being counted
over the whole corpus; so that one shingle is the window's necessary prefix and
is all that documents are joined on. A hit fixes where the window would start;
length and position bounds drop what does not fit, and the words themselves are
compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import discard, map_batches, read, ship, texts_of, whole_text, written

WINDOW, SHINGLE = 10, 3
#: Benchmark words of one block. A block's index is what the driver builds and tasks
#: receive, so this bounds it; a larger benchmark is matched block after block.
BLOCK_WORDS = 400_000
#: Windows of one part of an item; parts, not items, are dealt to the blocks.
PART_WINDOWS = 10_000
#: Copies of a text's hits in the join to the rows that hold the text.
SALTS = 16

_FOLD = bytes(b + 32 if 65 <= b < 91 else b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.encode().translate(_FOLD).split()


def starts_with(ids: np.ndarray, k: int) -> np.ndarray:
    """Code of the k-word shingle at each position; -1 where a word is unknown."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    code, known = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(k):
        part = ids[j : j + n]
        code = code << 21 | part
        known &= part >= 0
    return np.where(known, code, -1)


@dataclass
class Group:
    """The distinct windows of one length, with the shingles they are found by."""

    length: int
    k: int
    windows: np.ndarray  # (windows, length) word numbers
    shingles: np.ndarray  # all shingles of the windows, sorted
    owner_from: np.ndarray  # items of window i: owners[owner_from[i]:owner_from[i + 1]]
    owners: np.ndarray
    prefix: np.ndarray | None = None  # sorted prefix shingle of each entry
    entry: np.ndarray | None = None  # its window
    offset: np.ndarray | None = None  # its place in the window

    def rank(self, counts: np.ndarray) -> None:
        """Take each window's rarest shingle, the first of equals, as its prefix."""
        codes = np.stack([starts_with(w, self.k) for w in self.windows]) if len(self.windows) else np.zeros((0, 1), np.int64)
        seen = counts[np.searchsorted(self.shingles, codes)] if len(self.shingles) else codes
        first = seen.argmin(1)
        prefix = codes[np.arange(len(codes)), first]
        order = np.argsort(prefix, kind="stable")
        self.prefix, self.entry, self.offset = prefix[order], order, first[order]

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, windows) of all occurrences in a document."""
        codes = starts_with(ids, self.k)
        at = np.flatnonzero(codes >= 0)
        low = np.searchsorted(self.prefix, codes[at], "left")
        many = np.searchsorted(self.prefix, codes[at], "right") - low
        at, low, many = at[many > 0], low[many > 0], many[many > 0]
        entry = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        start = np.repeat(at, many) - self.offset[entry]
        fits = (start >= 0) & (start <= len(ids) - self.length)
        start, entry = start[fits], entry[fits]
        if not len(start):
            return start, start
        same = (ids[start[:, None] + np.arange(self.length)] == self.windows[self.entry[entry]]).all(1)
        return start[same], self.entry[entry[same]]


@dataclass
class Index:
    """Windows of a block of items, shipped to the tasks."""

    vocabulary: dict[bytes, int]
    items: list[str]
    groups: list[Group]

    def ids(self, text: str) -> np.ndarray:
        words = words_of(text)
        get = self.vocabulary.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))


def build_index(items: list[tuple[str, str]]) -> Index:
    """``items``: (id, text) pairs; an item of fewer than ten words is one window."""
    vocabulary: dict[bytes, int] = {}
    names = sorted({i for i, _ in items})
    number = {i: k for k, i in enumerate(names)}
    found: dict[int, dict[tuple, set]] = {}
    for name, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)]
        length = min(WINDOW, len(ids))
        for i in range(len(ids) - length + 1 if ids else 0):
            found.setdefault(length, {}).setdefault(tuple(ids[i : i + length]), set()).add(number[name])
    if len(vocabulary) >= 2**21:
        raise ValueError("a block of the benchmark has 2**21 different words or more")
    groups = []
    for length, windows in sorted(found.items()):
        k = min(SHINGLE, length)
        array = np.array(list(windows), np.int64).reshape(len(windows), length)
        shingles = np.unique(np.concatenate([starts_with(w, k) for w in array]))
        owners = [sorted(o) for o in windows.values()]
        groups.append(Group(length, k, array, shingles, np.cumsum([0, *map(len, owners)]), np.array([x for o in owners for x in o], np.int64)))
    return Index(vocabulary, names, groups)


def rank_by_corpus(index: Index, texts: DataFrame) -> None:
    """Count the index's shingles over all texts and choose the prefixes.

    Each task adds up its own counts; what it hands on, and what the driver
    collects, has at most one row for each shingle of the block.
    """

    def run(batches):
        sums = [np.zeros(len(g.shingles), np.int64) for g in index.groups]
        for b in batches:
            for t in texts_of(b, "t"):
                ids = index.ids(t)
                for g, s in zip(index.groups, sums):
                    codes = starts_with(ids, g.k)
                    codes = codes[codes >= 0]
                    at = np.searchsorted(g.shingles, codes)
                    at = at[(at < len(s)) & (g.shingles[np.minimum(at, len(s) - 1)] == codes)]
                    s += np.bincount(at, minlength=len(s))
        for k, s in enumerate(sums):
            at = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k), pa.int32()), pa.array(at), pa.array(s[at])], names=["g", "s", "n"])

    ship(texts.sparkSession)
    rows = texts.mapInArrow(run, "g int, s bigint, n bigint").groupBy("g", "s").agg(F.sum("n").alias("n")).toPandas()
    for k, g in enumerate(index.groups):
        counts, own = np.zeros(len(g.shingles), np.int64), rows[rows.g == k]
        counts[own.s.to_numpy()] = own.n.to_numpy()
        g.rank(counts)


def parts(items: DataFrame, item: str, text: str) -> DataFrame:
    """``i, t``: the items cut into runs of at most ``PART_WINDOWS`` windows, each run once.

    Neighbouring parts share the words that a window between them needs, so the
    parts have the item's windows. An item's parts are rows of their own: neither
    a long item nor an id of many rows has to be in one block.
    """
    rows = items.select(F.col(item).cast("string").alias("i"), F.col(text).cast("string").alias("t")).filter("i is not null and t is not null")

    def make():
        def batch(b):
            out = []
            for t in texts_of(b, "t"):
                words = words_of(t)
                starts = range(0, max(1, len(words) - WINDOW + 1), PART_WINDOWS)
                out.append([b" ".join(words[s : s + PART_WINDOWS + WINDOW - 1]).decode() for s in starts])
            return [pa.array(out, pa.list_(pa.string()))]

        return batch

    cut = map_batches(rows, ["i"], "parts array<string>", make)
    return cut.select("i", F.explode("parts").alias("t")).filter("t != ''").distinct()


def blocks(cut: DataFrame, n: int) -> Iterator[Index]:
    """Indexes over the parts, ``n`` of them, each built when it is asked for."""
    block = F.pmod(F.xxhash64("i", "t"), F.lit(n))
    for k in range(n):
        got = (cut.filter(block == k) if n > 1 else cut).collect()
        if got:
            yield build_index(sorted((r.i, r.t) for r in got))


def digest(text: str) -> Column:
    return F.sha2(F.col(text).cast("binary"), 256)


def contaminated(docs: DataFrame, items: DataFrame, carry: list[str], text: str = "text", item: str = "item_id", item_text: str = "text", prefix: str = "") -> DataFrame:
    """``carry`` with ``n_words``, ``spans`` and ``items`` of each row.

    ``spans`` are the hit words as [start, end) word numbers, disjoint and in
    order; ``items`` the ids (as strings, sorted, each once) of the items with a
    window in the text. Nulls: a null text has no words; an item without text or
    id is left out. Repeated rows each give their own row; items with the same
    text are all listed; an empty table on either side gives no hits. Only the
    named columns are read; ``prefix`` sets the new columns apart from carried
    ones of that name.
    """
    inner = [f"c{i}" for i in range(len(carry))]
    frame = docs.select(*[F.col(c).alias(i) for c, i in zip(carry, inner)], whole_text(text).alias("t"))
    frame = frame.withColumns({"spans": F.lit(None).cast("array<struct<start:bigint,end:bigint>>"), "items": F.array().cast("array<string>"), "n_words": F.lit(0).cast("bigint")})
    cut, cut_at = written(parts(items, item, item_text), "benchmark-parts")
    size = cut.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-size // (6 * BLOCK_WORDS)))
    texts = docs.select(whole_text(text).alias("t"))
    new = "n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"
    empty, hits = Index({}, [], []), []
    for index in blocks(cut, n):
        rank_by_corpus(index, texts)
        if n == 1:
            frame = map_batches(frame, [*inner, "t"], new, lambda index=index: lambda b: match(b, index))
        else:
            # written, so that the block's index is not needed any more
            bare = frame.select("t", digest("t").alias("key"), "spans", "items")
            found = map_batches(bare, ["key"], new, lambda index=index: lambda b: match(b, index)).filter(F.size("spans") > 0)
            hits.append(written(found.groupBy("key").agg(F.first("spans").alias("spans"), F.first("items").alias("items")), "benchmark-hits")[0])
    discard(docs.sparkSession, cut_at)
    if hits:
        every = reduce(DataFrame.unionByName, hits).groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
        every = every.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = frame.drop("spans", "items").withColumns({"key": digest("t"), "salt": F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")})
        frame = rows.join(every, ["key", "salt"], "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    if n > 1 or not size:
        frame = map_batches(frame, [*inner, "t"], new, lambda: lambda b: match(b, empty))
    return frame.select(*[F.col(i).alias(c) for i, c in zip(inner, carry)], F.col("n_words").alias(prefix + "n_words"), F.coalesce("spans", F.array()).alias(prefix + "spans"), F.col("items").alias(prefix + "items"))


def match(batch: pa.RecordBatch, index: Index) -> list[pa.Array]:
    """Hits of one block in a batch, joined to those of the blocks before."""
    n_words, spans, items = [], [], []
    col = lambda c: batch.column(batch.schema.get_field_index(c)).to_pylist()
    for t, old_spans, old_items in zip(texts_of(batch, "t"), col("spans"), col("items")):
        ids = index.ids(t)
        n_words.append(len(ids))
        change, names = np.zeros(len(ids) + 1, np.int64), set(old_items)
        for s in old_spans or ():
            change[s["start"]] += 1
            change[s["end"]] -= 1
        for g in index.groups if len(ids) and ids.max() >= 0 else ():
            start, window = g.find(ids)
            np.add.at(change, start, 1)
            np.add.at(change, start + g.length, -1)
            for w in np.unique(window):
                names.update(index.items[o] for o in g.owners[g.owner_from[w] : g.owner_from[w + 1]])
        hit = np.diff(np.concatenate([[0], (np.cumsum(change) > 0).astype(np.int8), [0]]))
        spans.append([{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(hit > 0), np.flatnonzero(hit < 0))])
        items.append(sorted(names))
    return [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(items, pa.list_(pa.string()))]


def op9_decontamination(spark, sf_dir):
    """Contract query: hits of the benchmark's windows in every document."""
    out = contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"])
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return out.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
  UNION ALL
  SELECT 'i', item_id, row_number() OVER (),
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
lens AS (SELECT DISTINCT least(10, len(ws)) AS k FROM w WHERE kind = 'i' AND len(ws) > 0),
win AS (SELECT DISTINCT id AS item_id, k, array_to_string(ws[p:p + k - 1], ' ') AS s
        FROM (SELECT id, ws, least(10, len(ws)) AS k, unnest(generate_series(1, len(ws) - least(10, len(ws)) + 1)) AS p FROM w WHERE kind = 'i' AND len(ws) > 0)),
dw AS (SELECT id, rid, p, k, array_to_string(ws[p:p + k - 1], ' ') AS s
       FROM (SELECT id, rid, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS p FROM w, lens WHERE kind = 'd' AND len(ws) >= k)),
hit AS (SELECT dw.rid, dw.p, win.k, win.item_id FROM dw JOIN win USING (k, s)),
words AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(generate_series(p, p + k - 1)) AS q FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY rid)
SELECT w.id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN words USING (rid) LEFT JOIN items USING (rid) WHERE kind = 'd'
"""


def stage_decontamination(spark, docs, sf_dir):
    """Pipeline stage: documents that hold a window of the benchmark go."""
    out = contaminated(docs, read(spark, sf_dir, "benchmark"), docs.columns, prefix="__bench_")
    return out.filter(F.size("__bench_spans") == 0).select(*docs.columns)
