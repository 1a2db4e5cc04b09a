"""Vector code compression: one codebook per part of a vector, fitted with bounds.

Components become integers, ``floor(4096 x)``; a vector is cut into equal
consecutive parts, and each part position has a codebook of entries. Every round
assigns each part to its nearest entry (squared Euclidean distance, ties to the
lower index), then moves each entry to the floored mean of its parts.

Most parts keep their entry, and bounds show it without a look at all entries. Per
part a row keeps its entry, an upper bound on the distance to it and a lower bound
on the distance to every other entry, each exact at the round stamped on it. The
codebooks of all rounds are kept, so a bound that was exact in round t holds in
round r after adding (or taking off) the *net* displacement of the entry from round
t to round r: the norm of the summed moves, which is never more than the sum of
their norms, and far less where an entry moves to and fro. A part is scanned over
all entries only if its bounds still meet after its upper bound was made exact.

Each round is one pass over a table of rows and bounds in the shared folder, and
writes the next such table; a task's sums go beside its rows, so that they count
once however often a task is run. What reaches the driver is one number for each
entry, component and round. Bounds never decide a tie: distances are integers.

Defined results: rows whose vector is null or holds a null or a component that
isn't finite are dropped, all others are kept, also repeated ids and null ids (last
in the order of ids). A vector shorter than the longest counts as filled up with
zeros, as does a length that the parts don't divide. Integers are held to what 64
bits can square and sum over a vector (2^27 at 64 components, |x| = 32,768); a sum
of errors over a label that leaves 64 bits is null. Fewer rows than entries make a
smaller codebook. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import discard, read, ship, written
from txrisk.llm.neighbours import matrix
from txrisk.operators.features import join_group_stats

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6

#: What a row keeps of each part: entry, the rounds of both bounds, and the bounds.
BOUNDS = [("entry", "u1"), ("upper_at", "u1"), ("lower_at", "u1"), ("upper", "<f8"), ("lower", "<f8")]

CODED = "vec_id long, label string, x array<double>, bounds binary, code string, error long, sums array<bigint>"


def finite_vector(vector: str) -> Column:
    x = F.col(vector)
    return F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))), F.lit(False))


def integers(x: np.ndarray, parts: int) -> np.ndarray:
    """(rows, parts, width) integers floor(4096 x), held to what can be squared and summed."""
    most = math.isqrt(2**62 // x.shape[1]) // 2
    return np.clip(np.floor(x * SCALE), -most, most).astype(np.int64).reshape(len(x), parts, -1)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """(rows, entries) exact squared distances of parts (rows, width)."""
    return np.stack([((x - e) ** 2).sum(axis=1) for e in entries], axis=1)


def net_moves(history: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """From each round t to the last: how far every entry is from where it was, and
    for every entry the farthest that any *other* one is; (rounds, parts, entries)."""
    now = history[-1]
    moved = np.stack([np.sqrt(((now - then).astype(np.float64) ** 2).sum(axis=2)) for then in history])
    others = np.zeros_like(moved)
    for e in range(moved.shape[2]):
        rest = np.delete(moved, e, axis=2)
        others[:, :, e] = rest.max(axis=2) if rest.shape[2] else 0.0
    return moved, others


def apart(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Whether the upper bound is surely below the lower one, whatever was rounded."""
    return upper * (1 + 1e-9) + 1e-6 < lower * (1 - 1e-9)


def assign(x: np.ndarray, state: np.ndarray | None, history: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """The rows' state (rows, parts) for the newest codebook, from that of an earlier
    round or from nothing; and how many parts were scanned over all entries."""
    now, r = history[-1], len(history) - 1
    if state is None:
        state, scan = np.zeros(x.shape[:2], dtype=BOUNDS), np.ones(x.shape[:2], dtype=bool)
    else:
        moved, others = net_moves(history)
        p = np.arange(x.shape[1])
        upper = state["upper"] + moved[state["upper_at"], p, state["entry"]]
        lower = state["lower"] - others[state["lower_at"], p, state["entry"]]
        scan = ~apart(upper, lower)
        # the bound on the own entry is made exact before any scan
        rows, at = np.nonzero(scan)
        own = now[at, state["entry"][rows, at]]
        exact = np.sqrt(((x[rows, at] - own) ** 2).sum(axis=1).astype(np.float64))
        state = state.copy()
        state["upper"][rows, at] = exact
        state["upper_at"][rows, at] = r
        scan[rows, at] = ~apart(exact, lower[rows, at])
    for p in range(x.shape[1]):
        rows = np.flatnonzero(scan[:, p])
        if not len(rows):
            continue
        d = squared(x[rows, p], now[p])
        best = d.argmin(axis=1)
        near = d[np.arange(len(rows)), best]
        d[np.arange(len(rows)), best] = np.iinfo(np.int64).max
        state["entry"][rows, p] = best
        state["upper"][rows, p], state["lower"][rows, p] = np.sqrt(near.astype(np.float64)), np.sqrt(d.min(axis=1).astype(np.float64))
        state["upper_at"][rows, p] = state["lower_at"][rows, p] = r
    return state, int(scan.sum())


def _round(history: list[np.ndarray], dims: int, last: bool):
    """Task function of a round: rows with their new state and, as a row of its own
    at the task's end, the sums and counts of each entry's parts. The last round
    gives codes and errors instead."""
    parts, entries, width = history[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), dtype=np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = integers(matrix(batch.column(2), dims), parts)
            kept = batch.column(3)
            state = None if kept.null_count else np.frombuffer(b"".join(kept.to_pylist()), dtype=BOUNDS).reshape(n, parts)
            state, _ = assign(x, state, history)
            entry = state["entry"]
            nothing = lambda kind: pa.nulls(n, kind)
            if last:
                own = history[-1][np.arange(parts), entry]
                error = ((x - own) ** 2).sum(axis=(1, 2))
                code = pa.array([row.tobytes().hex() for row in entry], pa.string())
                new = [nothing(pa.list_(pa.float64())), nothing(pa.binary()), code, pa.array(error, pa.int64())]
            else:
                for p in range(parts):
                    np.add.at(sums[p, :, :width], entry[:, p], x[:, p])
                    sums[p, :, width] += np.bincount(entry[:, p], minlength=entries)
                new = [batch.column(2), pa.array([row.tobytes() for row in state], pa.binary()), nothing(pa.string()), nothing(pa.int64())]
            yield _coded([batch.column(0), batch.column(1), *new, nothing(pa.list_(pa.int64()))])
        if not last and sums.any():
            kinds = [pa.int64(), pa.string(), pa.list_(pa.float64()), pa.binary(), pa.string(), pa.int64()]
            yield _coded([*(pa.nulls(1, k) for k in kinds), pa.array([sums.ravel().tolist()], pa.list_(pa.int64()))])

    return run


def _coded(columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "x", "bounds", "code", "error", "sums"])


def _moved(table: DataFrame, old: np.ndarray) -> np.ndarray:
    """The next codebook: the floored mean of each entry's parts, as summed by the tasks."""
    slots = table.filter("sums is not null").select(F.posexplode("sums").alias("slot", "v")).groupBy("slot").agg(F.sum("v").alias("v"))
    sums = np.zeros(old.shape[:2] + (old.shape[2] + 1,), dtype=np.int64)
    for r in slots.collect():
        sums.flat[r.slot] = r.v
    count = sums[:, :, -1:]
    return np.where(count > 0, sums[:, :, :-1] // np.maximum(count, 1), old)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every kept row and the final codebooks
    (parts, entries, width); ``vectors`` holds vec_id, embedding and label."""
    spark = vectors.sparkSession
    ship(spark)
    kept = vectors.filter(finite_vector("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("x"))
    longest = kept.agg(F.max(F.size("x"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], "vec_id long, label string, code string, error long"), np.zeros((parts, 0, 1), dtype=np.int64)
    dims = max(1, -(-longest // parts)) * parts
    start = np.zeros((0, dims))
    for r in kept.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect():
        start = np.vstack([start, np.pad(np.asarray(r.x, dtype=np.float64), (0, dims - len(r.x)))])
    history = [np.ascontiguousarray(integers(start, parts).transpose(1, 0, 2))]

    table, at = kept.withColumn("bounds", F.lit(None).cast("binary")), None
    for r in range(rounds + 1):
        rows = table if at is None else table.filter("sums is null").select("vec_id", "label", "x", "bounds")
        coded, new_at = written(rows.mapInArrow(_round(list(history), dims, last=r == rounds), CODED), "codes")
        if at is not None:
            discard(spark, at)
        table, at = coded, new_at
        if r < rounds:
            history.append(_moved(table, history[-1]))
    return table.select("vec_id", "label", "code", "error"), history[-1]


def op12_codes(spark, sf_dir):
    """Codes and errors of all rows of ``embeddings``."""
    codes, codebooks = compress(read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    digest = hashlib.sha256(",".join(str(v) for v in codebooks.ravel().tolist()).encode()).hexdigest()
    named = codes.withColumn("k", F.coalesce(F.concat(F.lit("="), "label"), F.lit("")))
    per_label = named.groupBy("k").agg(F.try_sum("error").alias("label_error"))
    return join_group_stats(named, per_label, "k").select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The rounds written out, every part against every entry of its codebook."""
    ctes = [f"""kept AS MATERIALIZED (
  SELECT vec_id, label, embedding AS x, len(embedding) // {parts} AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)""", """comp AS MATERIALIZED (
  SELECT vec_id, (i - 1) // w AS part, (i - 1) % w AS pos, CAST(floor(4096 * CAST(x[i] AS DOUBLE)) AS BIGINT) AS v
  FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM kept))""", f"""book0 AS MATERIALIZED (
  SELECT part, r - 1 AS entry, pos, v FROM comp
  JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS r FROM kept) f USING (vec_id) WHERE r <= {entries})"""]
    for r in range(rounds + 1):
        ctes.append(f"""near{r} AS MATERIALIZED (
  SELECT vec_id, part, min_by(entry, (d, entry)) AS entry, min(d) AS d
  FROM (SELECT c.vec_id, c.part, b.entry, CAST(sum((c.v - b.v) * (c.v - b.v)) AS BIGINT) AS d
        FROM comp c JOIN book{r} b ON c.part = b.part AND c.pos = b.pos GROUP BY ALL)
  GROUP BY vec_id, part)""")
        if r < rounds:
            ctes.append(f"""book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, coalesce(m.v, b.v) AS v
  FROM book{r} b LEFT JOIN (SELECT c.part, n.entry, c.pos, CAST(floor(sum(c.v) / count(*)) AS BIGINT) AS v
    FROM comp c JOIN near{r} n ON c.vec_id = n.vec_id AND c.part = n.part GROUP BY ALL) m
  ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos)""")
    return "WITH " + ",\n".join(ctes) + f""",
digest AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) AS h FROM book{rounds}),
codes AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM codes JOIN kept USING (vec_id), digest"""
