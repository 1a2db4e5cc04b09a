"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import discard, written


def _known(df: DataFrame) -> DataFrame:
    """A second reading of a table that may be joined to the first."""
    return df.select(F.col("hi").alias("k"), F.col("p").alias("kp"))


def components(edges: DataFrame, within: str = "") -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) that isn't its component's smallest.

    Each round hangs every node that has a smaller neighbour below its smallest
    one, shortens the resulting trees by pointer doubling, and contracts the
    edges onto the trees' roots; rounds end when no edge is left. Work is in
    joins and grouped minima over the edges, each round's tables written to the
    shared folder; nothing but emptiness is learnt by the driver.
    """
    oriented = edges.filter("u <> v").select(F.least("u", "v").alias("lo"), F.greatest("u", "v").alias("hi"))
    spark = edges.sparkSession
    left, at = written(oriented.distinct(), "edges", within)
    roots, roots_at = None, None
    while not left.isEmpty():
        parents, p_at = written(left.groupBy("hi").agg(F.min("lo").alias("p")), "parents", within)
        while not parents.join(_known(parents), F.col("p") == F.col("k")).isEmpty():
            shorter = parents.join(_known(parents), F.col("p") == F.col("k"), "left").select("hi", F.coalesce("kp", "p").alias("p"))
            shorter, s_at = written(shorter, "parents", within)
            discard(spark, p_at)
            parents, p_at = shorter, s_at
        fresh = parents.select(F.col("hi").alias("node"), F.col("p").alias("root"))
        if roots is not None:
            old = roots.join(_known(parents), F.col("root") == F.col("k"), "left").select("node", F.coalesce("kp", "root").alias("root"))
            fresh = old.unionByName(fresh)
        roots, new_at = written(fresh, "roots", within)
        if roots_at:
            discard(spark, roots_at)
        roots_at = new_at
        for end in ("lo", "hi"):
            others = [c for c in ("lo", "hi") if c != end]
            left = left.join(_known(parents), F.col(end) == F.col("k"), "left").select(*others, F.coalesce("kp", end).alias(end))
        rest = left.filter("lo <> hi").select(F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi")).distinct()
        rest, r_at = written(rest, "edges", within)
        discard(spark, at)
        discard(spark, p_at)
        left, at = rest, r_at
    if roots is None:
        return left.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots
