"""Alert table: flagged transactions with reason and severity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.columns import alert_reason, is_flagged, severity
from txrisk.operators.features import COUNT_COLUMN, base_features
from txrisk.operators.scoring import score_linear
from txrisk.params import ScoringParams
from txrisk.schema import ALERT_SCHEMA, assert_schema


def build_alerts(scored: DataFrame, p: ScoringParams, threshold: float | None = None) -> DataFrame:
    """score >= threshold (default: the alert threshold) → 5 alert columns."""
    t = p.alert_threshold if threshold is None else threshold
    out = (
        scored.filter(is_flagged("risk_score", t))
        .select(
            "transaction_id",
            "ts",
            "risk_score",
            alert_reason("amount", "country", p).alias("reason"),
            severity("risk_score", p).alias("severity"),
        )
    )
    return assert_schema(out, ALERT_SCHEMA)


def alert_detail(alerts: DataFrame, tx: DataFrame) -> DataFrame:
    """Alerts with the country, merchant and amount of their transaction.

    Inner equi-join on the key; both sides are keyed, so the join is 1:1.
    """
    detail = tx.select("transaction_id", "country", "merchant", "amount")
    return alerts.join(detail, on="transaction_id", how="inner").select(
        "ts", "transaction_id", "severity", "risk_score", "reason", "country", "merchant", "amount"
    )


def latest_scored(tx: DataFrame, p: ScoringParams, n: int) -> DataFrame:
    """The newest ``n`` transactions, scored.

    The rows are chosen first; only their customers' rows of the window before
    them are then counted (at most ``n`` rows are joined to, so broadcasting
    them is bounded), instead of counting and scoring the whole table.
    """
    top = recent(tx, n)
    window = F.expr(f"INTERVAL {p.window_seconds} SECONDS")
    probe = top.select(F.col("transaction_id").alias("_id"), F.col("customer_id").alias("_customer"), F.col("ts").alias("_ts"))
    near = tx.select("customer_id", "ts").join(
        F.broadcast(probe),
        (F.col("customer_id") == F.col("_customer")) & (F.col("ts") <= F.col("_ts")) & (F.col("ts") >= F.col("_ts") - window),
    )
    counts = near.groupBy("_id").agg(F.count(F.lit(1)).cast("int").alias(COUNT_COLUMN))
    counted = top.join(counts, F.col("transaction_id") == F.col("_id"), "left").withColumn(COUNT_COLUMN, F.coalesce(COUNT_COLUMN, F.lit(0))).drop("_id")
    return score_linear(base_features(counted, p), p)


def recent(df: DataFrame, n: int, columns: list[str] | None = None) -> DataFrame:
    """Newest ``n`` rows by event time (NULL times last, id breaks ties).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps
    its own top n, so only n rows per task reach the final merge.
    """
    cols = columns or df.columns
    return df.orderBy(F.col("ts").desc_nulls_last(), F.col("transaction_id").asc()).limit(n).select(*cols)
