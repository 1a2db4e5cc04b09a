"""Near-duplicates by b-bit MinHash.

A document is the set of its five-word shingles. Documents with equal sets are
one node. The first 128 of a node's 1,024 minima give 32 band keys of four minima
each; two bits of all minima are its packed signature. Nodes that share a band
key are candidates; the bit count of two signatures, corrected for chance
collisions, estimates their similarity, and what may reach the threshold is
decided on the full sets.

Only components are asked for, so pairs within a component need no test. First
each member of a band's bucket is tested against the bucket's smallest member;
then, where a bucket still spans several components, against a member chosen
anew for that bucket. So a group of m near copies costs about m tests.

What then shares a bucket with another component is mostly texts that are alike
but not linked, such as pages of one site's template, and pairs of them would
grow with the square of their number. They are refined by prefixes instead: with
the shingles of each set in one order, rarest first, two linked sets must share
one among the first few, and pages of a template differ in just these. So no
pair of different components that shares a band key goes untested, but only
pairs that share a necessary shingle are made.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import discard, folder, map_batches, read, ship, texts_of, whole_text, written
from txrisk.llm.components import components

SHINGLE_WORDS = 5
#: Linked from this similarity on, in percent.
PERCENT = 75
#: A pair at the threshold shares no band key with probability (1 - 0.75**4)**32 < 6e-6.
BANDS, ROWS = 32, 4
#: Minima of a signature. With two bits each, a pair at the threshold is estimated with a
#: standard deviation of 0.0163.
HASHES = 1024
#: An estimate below this is no link: 4.5 standard deviations under the threshold (3e-6).
LEAST_ESTIMATE = 0.677

_rng = np.random.default_rng(20240607)
_MUL = _rng.integers(1, 2**32, HASHES, np.uint32) | np.uint32(1)
_XOR = _rng.integers(0, 2**32, HASHES, np.uint32)
_WORD = _rng.integers(1, 2**63, SHINGLE_WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _rng.integers(1, 2**63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; fewer words make one shingle of all."""
    words = text.encode().translate(_LOWER).split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    size = min(n, SHINGLE_WORDS)
    out = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        out += h[k : n - size + 1 + k] * _WORD[k]
    return np.unique(mix(out))


def digest_of(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def minima(shingles: np.ndarray) -> np.ndarray:
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 2**32 - 1, np.uint32)
    for i in range(0, len(low), 128):
        h = low[i : i + 128, None] ^ _XOR
        np.multiply(h, _MUL, out=h)
        np.minimum(out, h.min(0), out=out)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, the bands' keys apart from each other."""
    rows = m[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    sums = (rows * _BAND).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
    return mix(sums).view(np.int64)


def packed(m: np.ndarray) -> np.ndarray:
    """Two bits of each minimum, 32 minima to a 64-bit integer."""
    two = ((m * np.uint32(0x9E3779B1)) >> np.uint32(30)).astype(np.uint64).reshape(-1, HASHES // 32, 32)
    return (two << (2 * np.arange(32, dtype=np.uint64))).sum(2, dtype=np.uint64).view(np.int64)


def estimate(x: str, y: str) -> Column:
    """Similarity of the signatures in arrays ``x`` and ``y``: the share of equal two-bit
    groups, less the quarter that unequal minima agree on by chance."""
    differ = F.lit(0)
    for i in range(HASHES // 32):
        d = F.col(x)[i].bitwiseXOR(F.col(y)[i])
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differ = differ + F.bit_count(d)
    return ((1 - differ / HASHES) - 0.25) / 0.75


def signed(docs: DataFrame, carry: list[str], text: str) -> DataFrame:
    """``c0``... with the set's size, digest, band keys and signature."""
    inner = [f"c{i}" for i in range(len(carry))]
    frame = docs.select(*[F.col(c).alias(i) for c, i in zip(carry, inner)], whole_text(text).alias("t"))

    def make():
        def batch(b):
            sets = [shingle_set(t) for t in texts_of(b, "t")]
            m = np.array([minima(s) for s in sets], np.uint32).reshape(-1, HASHES)
            return [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([digest_of(s) for s in sets], pa.binary()),
                pa.array(list(band_keys(m)), pa.list_(pa.int64())),
                pa.array(list(packed(m)), pa.list_(pa.int64())),
            ]

        return batch

    return map_batches(frame, inner, "n bigint, node binary, bands array<bigint>, sig array<bigint>", make)


#: Bits of the filter that tells tasks which rows are wanted: 2 MB, whatever the data.
FILTER_BITS = 2**24


def wanted_filter(wanted: DataFrame) -> np.ndarray:
    """Bits of the hashed ids of ``wanted``, for a first look in the tasks.

    At most ``FILTER_BITS`` / 64 words reach the driver. A set bit may be another
    id's; the join that follows decides.
    """
    bit = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    words = wanted.select(F.shiftright(bit, 6).alias("w"), (bit % 64).cast("int").alias("b")).groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[words.w.to_numpy(np.int64)] = words.bits.to_numpy(np.int64).view(np.uint64)
    return out


def sets_of(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(node, set) of the ``wanted`` (id, node), from the texts.

    Rows that the filter rules out never leave their task; the others' sets are
    made there and joined on their digest, so only wanted sets are shuffled.
    """
    bits = wanted_filter(wanted)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            at = b.column(1).to_numpy()
            some = np.flatnonzero(bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1))
            sets = [shingle_set(t) for t in b.column(0).take(pa.array(some)).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([digest_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "set"])

    made = docs.select(whole_text(text).alias("t"), place.alias("place")).mapInArrow(run, "node binary, set binary")
    return made.join(wanted.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])


def links(docs: DataFrame, text: str, nodes: DataFrame, candidates: DataFrame, within: str = "") -> tuple[DataFrame, str]:
    """Those of the ``candidates`` (a, b) whose full sets reach the threshold, as a written table and its place."""
    about = nodes.select(F.col("node").alias("k"), "id", "n", "sig")
    side = lambda x: about.select(*[F.col(c).alias(x + c) for c in about.columns])
    near = candidates.join(side("a"), F.col("a") == F.col("ak")).join(side("b"), (F.col("b") == F.col("bk")) & may_link("a", "b"))
    near, near_at = written(near.select("a", "aid", "b", "bid"), "candidates", within)
    wanted = near.select(F.col("aid").alias("id"), F.col("a").alias("node")).union(near.select("bid", "b"))
    sets, sets_at = written(sets_of(docs, text, wanted), "sets", within)
    pairs = near.select("a", "b").join(sets.select(F.col("node").alias("b"), F.col("set").alias("bset")), "b")
    pairs = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("aset")), "a").select("a", "b", "aset", "bset")

    def make():
        def batch(rows):
            out, last, x = [], None, None
            for s, y in zip(rows.column(2).to_pylist(), rows.column(3).to_pylist()):
                if s is not last and s != last:
                    last, x = s, np.frombuffer(s, np.uint64)
                y = np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            return [pa.array(out, pa.bool_())]

        return batch

    out, at = written(map_batches(pairs, ["a", "b"], "linked boolean", make).filter("linked").select("a", "b"), "links", within)
    discard(docs.sparkSession, near_at)
    discard(docs.sparkSession, sets_at)
    return out, at


def may_link(x: str, y: str) -> Column:
    """Neither size nor estimate rules the pair out."""
    sizes = 100 * F.least(x + "n", y + "n") >= PERCENT * F.greatest(x + "n", y + "n")
    return sizes & (estimate(x + "sig", y + "sig") >= LEAST_ESTIMATE)


#: Counters of shingles by hash, for the order of the prefixes: 2 MB, whatever the data.
COUNTERS = 2**18
#: Members of one shingle's group that meet in one task.
GROUP_ROWS = 1000


def counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(COUNTERS - 1)).astype(np.int64)


def counted(sets: DataFrame) -> np.ndarray:
    """How many of the shingles in ``sets`` fall on each counter, summed up in the cluster."""
    ship(sets.sparkSession)

    def run(batches):
        total = np.zeros(COUNTERS, np.int64)
        for b in batches:
            for s in b.column(0).to_pylist():
                np.add.at(total, counter(np.frombuffer(s, np.uint64)), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    sums = sets.select("set").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(COUNTERS, np.int64)
    out[sums["at"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


def prefix(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles by (count, value), of which a linked set of at most this size holds
    one. Any order does that is one for all sets; by counts the groups are small."""
    n = len(shingles)
    order = np.lexsort((shingles, counts[counter(shingles)]))
    return shingles[order[: n + 1 + (-PERCENT * n) // 100]]


def prefix_pairs(docs: DataFrame, text: str, nodes: DataFrame, members: DataFrame, within: str) -> DataFrame:
    """Pairs (a, b) of ``members`` (node, root) of different roots whose sets may be linked.

    Linked sets x and y, y not the larger, have in common at least 75 % of x and
    150/175 of y. So they share a shingle of x's prefix (all but so many, and one)
    and of y's, which is shorter; and of the first shared one's places in either
    follows how much they can share at most. A shingle's group is dealt to salts.
    Members of its commonest root, one large group of near copies maybe, meet the
    others but not each other.
    """
    about = members.select("node", "root").distinct().join(nodes.select("node", "id", "n"), "node")
    about, _ = written(about, "open", within)
    sets, _ = written(sets_of(docs, text, about.select("id", "node")).join(about.select("node", "root", "n"), "node"), "open-sets", within)
    counts = counted(sets)

    def make():
        def batch(b):
            return [pa.array([prefix(np.frombuffer(s, np.uint64), counts).view(np.int64) for s in texts_of(b, "set")], pa.list_(pa.int64()))]

        return batch

    rows = map_batches(sets, ["node", "root", "n"], "prefix array<bigint>", make)
    rows, _ = written(rows.select("node", "root", "n", F.posexplode("prefix").alias("place", "s")), "prefixes", within)
    by_root = rows.groupBy("s", "root").agg(F.count("*").alias("m"))
    groups = by_root.groupBy("s").agg(F.max_by("root", "m").alias("main"), F.sum("m").alias("m"), F.count("*").alias("roots")).filter("roots > 1")
    groups, _ = written(groups.select("s", "main", F.ceil(F.col("m") / GROUP_ROWS).cast("int").alias("salts")), "groups", within)
    live = rows.join(groups, "s").select("s", "salts", "node", "root", "n", "place", (F.col("root") == F.col("main")).alias("main"))
    live, _ = written(live, "shared", within)

    both = 100 + PERCENT
    least = F.expr(f"({2 * PERCENT} * n + {both - 1}) div {both}")
    meets = F.when(F.col("main"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    y = live.filter(F.col("place") < F.col("n") - least + 1).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    y = y.select("s", "salt", F.explode(meets).alias("main"), *[F.col(c).alias("y" + c) for c in ("node", "root", "n", "place")])
    x = live.withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))
    pairs = x.join(y, ["s", "salt", "main"]).filter(
        (F.col("root") != F.col("yroot"))
        & (F.struct("yn", "ynode") < F.struct("n", "node"))
        & (100 * F.col("yn") >= PERCENT * F.col("n"))
        & (both * F.least(F.col("n") - F.col("place"), F.col("yn") - F.col("yplace")) >= PERCENT * (F.col("n") + F.col("yn")))
    )
    return pairs.select(F.least("node", "ynode").alias("a"), F.greatest("node", "ynode").alias("b")).distinct()


def linked(docs: DataFrame, text: str, nodes: DataFrame, within: str) -> DataFrame:
    """(node, root) of the nodes that some link joins to a smaller one.

    What is joined to all members of a bucket is a written table, so that it is
    sent to the tasks where small, and a hot bucket's members are split where not.
    """
    spark = docs.sparkSession
    bands = nodes.select("node", F.explode("bands").alias("key"))
    leaders = bands.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("m")).filter("m > 1").select("key", "a")
    leaders, _ = written(leaders, "leaders", within)
    # all that later rounds need: the buckets of several members
    buckets, _ = written(bands.join(leaders, "key").select("key", "node", "a"), "buckets", within)
    found, found_at = links(docs, text, nodes, buckets.filter("node <> a").select("a", F.col("node").alias("b")).distinct(), within)
    roots = components(found.toDF("u", "v"), within)
    discard(spark, found_at)

    for closing in (False, True):
        now = buckets.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        now, now_at = written(now, "rooted", within)
        spans = now.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
        spans, _ = written(spans, "spans", within)
        members, at = written(now.join(spans, "key"), "open-buckets", within)
        discard(spark, now_at)
        if closing:
            more = prefix_pairs(docs, text, nodes, members, within)
        else:
            chosen = members.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", "key").alias("h"), "node", "root")).alias("c"))
            chosen, _ = written(chosen, "chosen", within)
            more = members.join(chosen, "key").filter(F.col("root") != F.col("c.root")).select(F.col("c.node").alias("a"), F.col("node").alias("b")).distinct()
        found, found_at = links(docs, text, nodes, more, within)
        discard(spark, at)
        known = lambda x: roots.select(F.col("node").alias(x + "k"), F.col("root").alias(x + "r"))  # noqa: B023, E731
        joined = found.join(known("a"), F.col("a") == F.col("ak"), "left").join(known("b"), F.col("b") == F.col("bk"), "left")
        over = components(joined.select(F.coalesce("ar", "a").alias("u"), F.coalesce("br", "b").alias("v")), within)
        discard(spark, found_at)
        if over.isEmpty():
            continue
        moved = over.select(F.col("node").alias("o"), F.col("root").alias("to"))
        old = roots.join(moved, F.col("root") == F.col("o"), "left").select("node", F.coalesce("to", "root").alias("root"))
        # roots that were moved, and nodes that had no link before
        roots, _ = written(old.unionByName(over), "roots", within)
    return roots


def near_duplicates(docs: DataFrame, text: str = "text", key: str | None = None) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of each row.

    Two documents are linked if 100 times their shingle sets' intersection is at
    least 75 times the union; ``component_id`` is the smallest id reachable over
    links, the document's own included, and ``kept`` whether it is the own one. A
    null or empty text has an empty set and is linked with nothing; a text of
    fewer than five words is one shingle. Rows with equal sets form one node, so
    any number of copies costs one row in what follows, and every row, repeated
    ones too, is returned. A null id is no candidate for a component's smallest,
    and such a row is kept only if its component has no id at all. An empty table
    gives an empty one. Only ``doc_id`` and the text are read. The result is a
    written table; the tables that led to it are gone.
    """
    within = f"duplicates-{uuid.uuid4().hex}"
    out, _ = written(_placed(docs, text, key, within), "near-duplicates")
    discard(docs.sparkSession, folder(docs.sparkSession, within))
    return out


def _placed(docs: DataFrame, text: str, key: str | None, within: str) -> DataFrame:
    docs = docs.select("doc_id", text, *([key] if key else []))
    rows, _ = written(signed(docs, ["doc_id", *([key] if key else [])], text), "signatures", within)
    order = F.struct(F.col("c0").isNull().alias("last"), "c0", *(["c1"] if key else []))
    nodes = rows.filter("n > 0").groupBy("node").agg(F.min("c0").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    nodes, _ = written(nodes, "nodes", within)
    roots = linked(docs, text, nodes, within)
    placed = nodes.select("node", "id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    owner = placed.join(smallest, "root").select("node", "component_id")
    if key:
        firsts = rows.filter("n > 0").groupBy("node").agg(F.min(order).alias("first"))
        known = placed.select("node", "root").join(firsts, "node")
        owner = owner.join(known.join(known.groupBy("root").agg(F.min("first").alias("winner")), "root").select("node", "winner"), "node")
        # a written table, so that the join is a broadcast where it is small and AQE splits a node of many rows where not
        owner, _ = written(owner, "owners", within)
        full = rows.filter("n > 0").select("c0", "c1", "n", "node").join(owner, "node").withColumn("kept", order.eqNullSafe(F.col("winner")))
        full = full.select("c0", "c1", "n", "component_id", "kept")
        out = full.unionByName(rows.filter("n = 0").select("c0", "c1", "n", F.col("c0").alias("component_id"), F.lit(True).alias("kept")))
        return out.select(F.col("c0").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", "kept", F.col("c1").alias(key))
    owner, _ = written(owner, "owners", within)
    full = rows.filter("n > 0").select("c0", "n", "node").join(owner, "node").select("c0", "n", "component_id")
    out = full.unionByName(rows.filter("n = 0").select("c0", "n", F.col("c0").alias("component_id")))
    return out.select(F.col("c0").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.col("c0").eqNullSafe(F.col("component_id")).alias("kept"))


def op7_minhash(spark, sf_dir):
    """Contract query: components of near-duplicates over all documents."""
    return near_duplicates(read(spark, sf_dir, "documents"))


def stage_dedup(spark, docs, sf_dir):
    """Pipeline stage: one document of each group stays.

    Rows are told apart by id and text digest, so that of a group the row that is
    first by id (null last) and digest stays, whatever ids repeat; of rows that
    share both id and text one stays. A text without words is in no group.
    """
    told = F.unhex(F.sha2(whole_text("text").cast("binary"), 256))
    state = near_duplicates(docs.select("doc_id", "text", told.alias("__dup_text")), key="__dup_text")
    state = state.select(F.col("doc_id").alias("__dup_id"), "__dup_text", "kept")
    by_id = state.groupBy("__dup_id").agg(F.bool_or("kept").alias("__dup_kept"), F.count("*").alias("__dup_rows"))
    # ids that go, and kept ids of several rows: mostly few, so that the texts need no shuffle
    other, _ = written(by_id.filter("not __dup_kept or __dup_rows > 1"), "not-kept-once")
    several = other.filter("__dup_kept").select(F.col("__dup_id").alias("__dup_of"))
    stay = state.filter("kept").join(several, F.col("__dup_id").eqNullSafe(F.col("__dup_of")), "left_semi").select("__dup_id", "__dup_text").distinct()
    stay, _ = written(stay, "kept-of-several")
    same = F.col("doc_id").eqNullSafe(F.col("__dup_id"))
    once = docs.join(other.select("__dup_id"), same, "left_anti")
    more = docs.join(stay, same & (told == F.col("__dup_text")), "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(more)


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(ws[p:p + least(5, len(ws)) - 1], ' ')) AS s
      FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS p FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * common >= 75 * (x.n + y.n - common)),
d AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, d.b FROM r JOIN d ON r.b = d.a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id, w.doc_id = m.component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) m ON w.doc_id = m.a
"""
