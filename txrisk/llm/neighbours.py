"""Approximate nearest neighbours by largest inner product: a permutation index.

A vector is represented by its ``PREFIX`` nearest of ``PIVOTS`` pivots, nearest
first. The rows are dealt by a hash of their id to blocks that fit a task; each
block posts its rows in one inverted file per pivot, with the place that the pivot
has in the row's order. A query reads the files of its own pivots only, adds up
what the shared pivots save of the footrule distance between both orders, takes
every row whose footrule distance is at most ``FARTHEST`` of the largest possible
one, and reranks those rows by the exact inner product. How many rows that are is
for the data to say: there is no cap. A query that finds fewer rows than asked for
is searched again over all rows.

Vectors of unequal length have unequal inner products with one and the same
direction, so orders are made on vectors with one more component, which makes all
rows equally long (a query has 0 there): the nearest row is then the one of largest
inner product.

The pivots are a bounded sample, the distinct vectors of lowest hash; all rows are
indexed. Every query meets every block, its vector being copied to each; a block's
queries stream past its index, so a task holds one block and one batch of queries.

Defined results: a vector that is null, zero, empty or holds a null or a component
that isn't finite takes no part, nor does a row without id. Of several rows with
one id the largest vector counts. A shorter vector counts as filled up with zeros.
Equal scores are ranked by id, and scores are summed left to right in double
precision, so equal vectors have equal scores. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import discard, read, ship, written

#: Neighbours of a query.
NEAREST = 20
#: Pivots, a bounded sample of the vectors, and how many of them order a vector.
PIVOTS = 512
PREFIX = 64
#: Footrule distance up to which a row is reranked, as a share of the largest one.
FARTHEST = 0.88
#: Rows of a block at most, and blocks that a smaller table is dealt to.
BLOCK_ROWS = 131_072
BLOCKS = 16
#: Queries are every row whose id this divides.
QUERY_EACH = 20

FOUND = "query_id long, vec_id long, score double"


def usable(vector: str) -> Column:
    """Neither null, zero nor empty, all components finite."""
    x = F.col(vector)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(x, lambda c: c != 0), F.lit(False))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors as rows of doubles, shorter ones filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lengths) and (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims))
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed left to right."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


def orders(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """The numbers of each row's k nearest pivots, nearest first; ties by number."""
    near = np.hstack([x, extra[:, None]]) @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :k]


def lift(x: np.ndarray, longest: float) -> np.ndarray:
    """The component that makes a vector as long as the longest one."""
    return np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", x, x), 0.0))


class Block:
    """The rows of a block and one inverted file per pivot."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, k: int, longest: float):
        self.ids, self.x, self.pivots, self.k = ids, x, pivots, k
        order = orders(x, lift(x, longest), pivots, k).ravel()
        by_pivot = np.argsort(order, kind="stable")
        starts = np.searchsorted(order[by_pivot], np.arange(1, len(pivots)))
        self.rows = np.split(by_pivot // k, starts)
        self.saves = np.split((k - by_pivot % k).astype(np.float64), starts)
        self.margin = 1e-13 * x.shape[1] * max(longest, 1e-300)

    def footrule_saved(self, queries: np.ndarray) -> Iterator[np.ndarray]:
        """For each query and the rows of this block: by how much half of the footrule
        distance between the orders is below its largest value k(k + 1) / 2. A pivot at
        places a and b, counted from 0, saves k - max(a, b), one that is missing in either
        nothing, so only the files of the query's own pivots are read."""
        for order in orders(queries, np.zeros(len(queries)), self.pivots, self.k):
            rows = np.concatenate([self.rows[p] for p in order])
            saves = np.concatenate([np.minimum(self.saves[p], self.k - a) for a, p in enumerate(order)])
            yield np.bincount(rows, saves, minlength=len(self.ids))

    def search(self, qids: np.ndarray, queries: np.ndarray, n: int, farthest: float) -> Iterator[tuple]:
        """(query id, row ids, scores) of each query's nearest rows in this block."""
        whole = self.k * (self.k + 1) / 2
        saved = self.footrule_saved(queries) if farthest < 1 else None
        for i, qid in enumerate(qids):
            near = np.flatnonzero(next(saved) >= (1 - farthest) * whole) if saved is not None else np.arange(len(self.ids))
            near = near[self.ids[near] != qid]
            if not len(near):
                continue
            rough = self.x[near] @ queries[i]
            if len(near) > n:  # the exact scores of those that rounding could bring under the first n
                least = np.partition(rough, len(rough) - n)[len(rough) - n]
                near = near[rough >= least - 2 * self.margin * np.sqrt(queries[i] @ queries[i])]
            score = inner(self.x[near], np.broadcast_to(queries[i], (len(near), self.x.shape[1])))
            best = np.lexsort((self.ids[near], -score))[:n]
            yield qid, self.ids[near][best], score[best]


def _search_blocks(pivots: np.ndarray, k: int, longest: float, dims: int, n: int, farthest: float):
    """Task function over rows sorted by block, a block's vectors before its queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, parts, block = None, [], [], None
        for batch in batches:
            blocks, asked = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            names, x = batch.column(2).to_numpy(), matrix(batch.column(3), dims)
            edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(asked) != 0)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(names)]):
                if lo == hi:
                    continue
                if blocks[lo] != at:
                    at, ids, parts, block = blocks[lo], [], [], None
                if not asked[lo]:
                    ids.append(names[lo:hi])
                    parts.append(x[lo:hi])
                    continue
                if block is None:
                    if not ids:
                        continue  # no vector was dealt to this block
                    block = Block(np.concatenate(ids), np.vstack(parts), pivots, k, longest)
                    ids, parts = [True], []
                found = list(block.search(names[lo:hi], x[lo:hi], n, farthest))
                if found:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]), pa.int64()),
                        pa.array(np.concatenate([f[1] for f in found]), pa.int64()),
                        pa.array(np.concatenate([f[2] for f in found]), pa.float64()),
                    ], names=["query_id", "vec_id", "score"])

    return run


def _first(found: DataFrame, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= n)


def nearest(base: DataFrame, queries: DataFrame, n: int = NEAREST, pivots: int = PIVOTS, prefix: int = PREFIX,
            farthest: float = FARTHEST) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``n`` nearest rows of ``base``
    (all rows if fewer), never a row of the query's own id.

    ``base`` and ``queries`` hold ``vec_id`` and ``embedding``."""
    spark = base.sparkSession
    ship(spark)

    def whole(df: DataFrame) -> DataFrame:
        one = df.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("x"))
        return one.filter(F.col("id").isNotNull() & usable("x")).groupBy("id").agg(F.max("x").alias("x"))

    rows, rows_at = written(whole(base).withColumn("h", F.xxhash64("x")), "vectors")
    asked, asked_at = written(whole(queries), "queries")
    length2 = F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    size = rows.agg(F.count(F.lit(1)), F.max(F.size("x")), F.max(length2)).first()
    asked_dims = asked.agg(F.max(F.size("x"))).first()[0]
    count = size[0]
    if not count or not asked_dims:
        return spark.createDataFrame([], FOUND).select("query_id", F.lit(0).alias("rank"), "vec_id", "score")
    dims, longest = max(size[1], asked_dims), float(np.sqrt(size[2]))

    lowest = [r[0] for r in rows.select("h").distinct().orderBy("h").limit(pivots).collect()]
    sample = rows.filter(F.col("h").isin(lowest)).groupBy("h").agg(F.max("x").alias("x")).orderBy("h").collect()
    chosen = np.zeros((len(sample), dims))
    for i, r in enumerate(sample):
        chosen[i, : len(r.x)] = r.x
    chosen = np.hstack([chosen, lift(chosen, longest)[:, None]])
    k = min(prefix, len(chosen))

    blocks = max(-(-count // BLOCK_ROWS), min(BLOCKS, count))

    def search(some: DataFrame, far: float) -> DataFrame:
        dealt = rows.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("asked"), "id", "x")
        copies = some.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("asked"), "id", "x")
        met = dealt.unionByName(copies).repartition(blocks, "block").sortWithinPartitions("block", "asked")
        return met.mapInArrow(_search_blocks(chosen, k, longest, dims, n, far), FOUND)

    found, found_at = written(_first(search(asked, farthest), n), "found")
    # a query may be a row itself, so one less than the rows can be asked for
    enough = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= n)
    short = asked.join(enough, F.col("id") == F.col("query_id"), "left_anti")
    if count > n and farthest < 1 and not short.isEmpty():
        full = found.join(enough, "query_id", "left_semi")
        whole_scan = _first(search(short, 1.0), n).select(*full.columns)
        both, _ = written(full.unionByName(whole_scan), "found")
        discard(spark, found_at)
        found = both
    elif count <= n and farthest < 1:
        discard(spark, found_at)
        found, _ = written(_first(search(asked, 1.0), n), "found")
    for path in (rows_at, asked_at):
        discard(spark, path)
    return found.select("query_id", "rank", "vec_id", "score")


def op11_neighbours(spark, sf_dir):
    """The 20 nearest rows of every row whose id 20 divides, against all rows."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(rows, rows.filter(F.col("vec_id") % QUERY_EACH == 0))
