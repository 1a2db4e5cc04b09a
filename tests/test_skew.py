"""A customer holding a third of all rows: exact results, split work."""

from __future__ import annotations

from pyspark.sql import functions as F

from tools.check_oracle import duck
from txrisk.operators import investigate
from txrisk.operators.features import group_zscore, trailing_count
from txrisk.sources.tables import Tables
from txrisk.sources.transactions import transactions

MID = "/root/testdata/sf0.01"
DAY_US = 86_400 * 10**6


def hot_frame(spark):
    """The sf0.01 transactions with every third row moved to one customer."""
    tx = transactions(Tables(spark, MID))
    hot = (F.col("transaction_id").cast("long") % 3) == 0
    return tx.withColumn("customer_id", F.when(hot, F.lit("HOT")).otherwise(F.col("customer_id")))


HOT_SQL = """
WITH t AS (
  SELECT CAST(e.event_id AS VARCHAR) AS transaction_id,
         CASE WHEN e.event_id % 3 = 0 THEN 'HOT' ELSE concat('C', format('{:06d}', e.user_id)) END AS customer_id,
         e.ts, round(greatest(1.0, e.value), 2) AS amount
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
)
SELECT transaction_id,
       CAST(count(*) OVER (PARTITION BY customer_id ORDER BY ts
            RANGE BETWEEN INTERVAL 86400 SECONDS PRECEDING AND CURRENT ROW) AS INTEGER) AS n
FROM t
"""


def test_hot_customer_trailing_count_is_exact_and_split(spark):
    df = hot_frame(spark)
    got = {r.transaction_id: r.tx_count_5min for r in trailing_count(df, DAY_US, 4).collect()}
    want = dict(duck(MID).execute(HOT_SQL).fetchall())
    assert got == want
    # the hot customer's rows are spread over many (customer, bucket) groups
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    groups = df.filter(F.col("customer_id") == "HOT").select((us / (4 * DAY_US)).cast("long").alias("b")).distinct()
    assert groups.count() >= 7
    assert df.filter(F.col("customer_id") == "HOT").count() * 3 >= df.count() - 3


def test_hot_customer_grains_are_exact_and_small(spark):
    """A third of the rows on one key and a window as long as the data: no group
    is larger than a grain."""
    from txrisk.operators.features import trailing_count_grains

    df = hot_frame(spark)
    hour = 3600 * 10**6
    got = {r.transaction_id: r.tx_count_5min for r in trailing_count_grains(df, DAY_US, hour).collect()}
    assert got == dict(duck(MID).execute(HOT_SQL).fetchall())
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    hot = df.filter(F.col("customer_id") == "HOT")
    assert hot.groupBy(F.floor(us / hour)).count().agg(F.max("count")).first()[0] * 20 < hot.count()


def test_rows_without_time_are_counted_among_themselves(spark):
    import datetime as dt

    from txrisk.operators.features import trailing_count_grains

    rows = [("a", "C", None), ("b", "C", None), ("c", "C", dt.datetime(2024, 1, 1)), ("d", None, dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, ts timestamp_ntz")
    for out in (trailing_count(df, DAY_US), trailing_count_grains(df, DAY_US, DAY_US // 7)):
        assert {r.transaction_id: r.tx_count_5min for r in out.collect()} == {"a": 2, "b": 2, "c": 1, "d": 1}


def test_hot_customer_aggregates(spark):
    df = hot_frame(spark).withColumn("risk_score", F.lit(0.9))
    summary = {r.customer_id: r.n_tx for r in investigate.customer_summary(df, 0.8).collect()}
    assert summary["HOT"] == df.filter(F.col("customer_id") == "HOT").count()
    tl = investigate.customer_timeline(df, 200)
    assert tl.filter(F.col("customer_id") == "HOT").count() == 200
    z = group_zscore(df).filter(F.col("customer_id") == "HOT").agg(F.avg("customer_zscore")).first()[0]
    assert abs(z) < 1e-9


def test_hot_customer_statistics_join_is_split(spark):
    """With broadcasts off and a third of the rows on one key, no task of the
    join back gets more than a small part of that key's rows."""
    from txrisk.operators.features import GROUP_SALTS, batch_customer_count

    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled",
                                          "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", str(4 * GROUP_SALTS))
        df = hot_frame(spark)
        hot = df.filter(F.col("customer_id") == "HOT").count()
        for out in (batch_customer_count(df), group_zscore(df)):
            tasks = out.filter(F.col("customer_id") == "HOT").groupBy(F.spark_partition_id()).count().collect()
            assert sum(r["count"] for r in tasks) == hot
            assert len(tasks) >= GROUP_SALTS // 3
            assert max(r["count"] for r in tasks) <= hot / 4
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_grain_totals_aggregate_rows_not_moves(spark):
    """What a task's aggregate of the totals holds is a grain of entry per row at
    most: sparse rows, each in a grain of its own, are no more groups than rows."""
    import datetime as dt

    from txrisk.operators.features import trailing_count_grains

    t0 = dt.datetime(2024, 1, 1)
    data = [(f"t{i}", f"C{i % 10}", t0 + dt.timedelta(days=i // 10, seconds=i * 37)) for i in range(400)]
    df = spark.createDataFrame(data, "transaction_id string, customer_id string, ts timestamp_ntz").coalesce(1)
    out = trailing_count_grains(df, DAY_US, DAY_US // 24)
    got = {r.transaction_id: r.tx_count_5min for r in out.collect()}
    assert got == {t: sum(c == c2 and s - dt.timedelta(days=1) <= s2 <= s for _, c2, s2 in data) for t, c, s in data}

    def nodes(n):
        inner = {"AdaptiveSparkPlanExec": lambda: [n.executedPlan()], **dict.fromkeys(("ShuffleQueryStageExec", "BroadcastQueryStageExec", "ResultQueryStageExec"), lambda: [n.plan()])}
        children = inner.get(n.getClass().getSimpleName(), lambda: [n.children().apply(i) for i in range(n.children().size())])()
        return [n] + [m for c in children for m in nodes(c)]

    aggregates = [n for n in nodes(out._jdf.queryExecution().executedPlan()) if n.nodeName() == "HashAggregate"]
    made = [n.metrics().apply("numOutputRows").value() for n in aggregates]
    assert made and max(made) <= len(data)
