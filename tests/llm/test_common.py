"""The bounded sample that classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import functions as F

from txrisk.llm.common import hash_sample


def test_sample_is_bounded_with_null_and_repeated_keys(spark):
    """A third of the rows have no key, a third the same one."""
    n = 60_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id")).alias("doc_id"),
        F.concat(F.lit("text "), F.col("id")).alias("t"))
    got = hash_sample(df, "doc_id", 1000)
    assert 150 < got.count() <= 1100
    assert got.filter("doc_id is null").count() == 0
    assert got.groupBy("doc_id").count().filter("count > 1").count() == 0
    assert sorted(map(tuple, hash_sample(df.repartition(7), "doc_id", 1000).collect())) == sorted(map(tuple, got.collect()))
    every = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("x").alias("t"))
    assert 900 < hash_sample(every, "doc_id", 1000).count() <= 1100


def test_small_tables_are_taken_whole_but_once_a_key(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (None, "c")], "doc_id long, t string")
    assert sorted(map(tuple, hash_sample(df, "doc_id", 10).collect())) == [(1, "a"), (2, None)]
    assert hash_sample(df.select("doc_id"), "doc_id", 10).count() == 2
    assert hash_sample(df.limit(0), "doc_id", 10).count() == 0
