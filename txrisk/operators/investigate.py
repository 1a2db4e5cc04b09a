"""Per-customer investigation, for all customers in one pass.

The original drill-down looks at one selected customer; here every
operator is keyed by ``customer_id`` so a single job answers for everyone
(select one customer with a filter on the result, which Catalyst pushes
below the aggregation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.columns import is_flagged, recommended_action, round_to
from txrisk.operators.features import finite

TIMELINE_COLUMNS = ["customer_id", "ts", "transaction_id", "amount", "country", "merchant", "category", "risk_score"]


def customer_summary(df: DataFrame, threshold: float) -> DataFrame:
    """Per customer: transactions, flagged, total amount, max score (amounts
    and scores that are no finite number are skipped).

    Map-side combined: a customer holding a third of the rows costs one
    partial row per task.
    """
    return df.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_tx"),
        F.count(F.when(is_flagged("risk_score", threshold), 1)).alias("n_flagged"),
        round_to(F.sum(finite("amount")), 6).alias("total_amount"),
        F.max(finite("risk_score")).alias("max_score"),
    )


def customer_top(df: DataFrame, column: str, k: int) -> DataFrame:
    """Top ``k`` values of ``column`` per customer by count (ties: value asc).

    Counting first (map-side combined) leaves one row per (customer, value);
    the ranking window then sees at most the number of distinct values per
    customer, not the customer's transactions.
    """
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy("customer_id", column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    w = Window.partitionBy("customer_id").orderBy(F.col("n").desc(), F.col(column).asc())
    return counts.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k)


def customer_timeline(df: DataFrame, n: int) -> DataFrame:
    """Newest ``n`` transactions of every customer (NULL times last,
    id breaks ties).

    ``row_number() <= n`` is planned with a partial WindowGroupLimit before
    the shuffle, so each task forwards at most ``n`` rows per customer: a
    hot customer does not move its whole history into one task.
    """
    w = Window.partitionBy("customer_id").orderBy(F.col("ts").desc_nulls_last(), F.col("transaction_id").asc())
    return (
        df.select(*TIMELINE_COLUMNS)
        .withColumn("rn", F.row_number().over(w).cast("int"))
        .filter(F.col("rn") <= n)
    )


def customer_actions(df: DataFrame, threshold: float, block_score: float = 0.95) -> DataFrame:
    """Per customer: very risky (>= max(block, t)) and review (>= t, < block)
    counts and the recommended action."""
    hi = max(block_score, threshold)
    s = F.col("risk_score")
    agg = df.groupBy("customer_id").agg(
        F.count(F.when(is_flagged(s, hi), 1)).alias("n_high"),
        F.count(F.when(is_flagged(s, threshold) & (s < F.lit(block_score)), 1)).alias("n_mid"),
    )
    return agg.withColumn("action", recommended_action("n_high", "n_mid"))


def for_customer(df: DataFrame, customer_id: str) -> DataFrame:
    """One customer's rows, from the unfiltered table (the drill-down filter).

    An equality filter: Catalyst places it before any shuffle of ``df``, so
    only that customer's rows travel.
    """
    return df.filter(F.col("customer_id") == F.lit(customer_id))


def customer_series(df: DataFrame, customer_id: str) -> DataFrame:
    """One customer's rows with an event time, oldest first (score and amount
    over time)."""
    return (
        for_customer(df, customer_id)
        .filter(F.col("ts").isNotNull())
        .select("ts", "transaction_id", "amount", "risk_score")
        .orderBy(F.col("ts").asc(), F.col("transaction_id").asc())
    )
