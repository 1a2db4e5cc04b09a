"""Monitoring aggregates over scored transactions: KPIs, per-minute rates,
rolling SLA, hotspots, filter options, histograms.

All of them are aggregations that combine map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.columns import at_least, in_lists, is_flagged, minute_floor, risk_level, round_to
from txrisk.operators.features import finite
from txrisk.params import MonitorParams, ViewFilter
from txrisk.session import materialize

VIEW_COLUMNS = ["ts", "transaction_id", "customer_id", "amount", "country", "merchant", "category", "risk_score"]


def view_filter(df: DataFrame, vf: ViewFilter) -> DataFrame:
    """Conjunction of three IN-lists; empty lists do not restrict."""
    return df.filter(in_lists([("country", vf.countries), ("merchant", vf.merchants), ("category", vf.categories)]))


def flagged(df: DataFrame, threshold: float) -> DataFrame:
    return df.filter(is_flagged("risk_score", threshold))


def kpi_summary(df: DataFrame, m: MonitorParams) -> DataFrame:
    """One row: transactions, flagged, alert rate % and risk level."""
    agg = df.agg(
        F.count(F.lit(1)).alias("n_tx"),
        F.count(F.when(is_flagged("risk_score", m.threshold), 1)).alias("n_flagged"),
    )
    rate = F.col("n_flagged") / at_least("n_tx", 1) * 100.0
    return agg.select(
        "n_tx",
        "n_flagged",
        round_to(rate, 6).alias("alert_rate_pct"),
        risk_level(rate, m.level_high_pct, m.level_moderate_pct).alias("risk_level"),
    )


def minute_rates(df: DataFrame, threshold: float) -> DataFrame:
    """Per minute of event time: transactions (non-null ids), flagged, rate %.

    Rows without an event time are dropped first.
    """
    return (
        df.filter(F.col("ts").isNotNull())
        .groupBy(minute_floor("ts").alias("minute"))
        .agg(
            F.count("transaction_id").alias("tx"),
            F.count(F.when(is_flagged("risk_score", threshold), 1)).alias("flagged"),
        )
        .withColumn("alert_rate_pct", F.col("flagged") / at_least("tx", 1) * 100.0)
    )


def sla_rolling(rates: DataFrame, window_rows: int) -> DataFrame:
    """Mean alert rate over the last ``window_rows`` *present* minutes
    (a row frame: gaps are not filled; the first minutes average fewer).

    An unpartitioned window would send the whole minute series to one task.
    Instead each minute gets its global rank = (minutes on earlier days) +
    (rank within its day): the within-day rank is a window partitioned by
    day (at most 1,440 rows each) and the day offsets are a running sum
    over the per-day counts, one row per calendar day. Each minute then
    sends its rate to the ``window_rows`` ranks it belongs to (carrying its
    own columns to its own rank), and one map-side-combined aggregation per
    rank yields the mean. The minute series, read by two branches, is
    materialised once (it is bounded by the time span, not the data).
    """
    n = int(window_rows)
    r = materialize(rates.withColumn("_day", F.to_date("minute")))
    per_day = r.groupBy("_day").agg(F.count(F.lit(1)).alias("_n"))
    # one row per calendar day with data: bounded by the time span
    offsets = per_day.select(
        "_day",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_start"),
    )
    ranked = (
        r.withColumn("_local", F.row_number().over(Window.partitionBy("_day").orderBy("minute")))
        .join(offsets, on="_day")
        .withColumn("_rank", F.col("_start") + F.col("_local"))
    )
    own = F.col("_k") == 0
    return (
        ranked.select(
            "minute", "tx", "flagged", "alert_rate_pct",
            F.posexplode(F.sequence(F.col("_rank"), F.col("_rank") + F.lit(n - 1))).alias("_k", "_target"),
        )
        .groupBy("_target")
        .agg(
            F.max(F.when(own, F.col("minute"))).alias("minute"),
            F.max(F.when(own, F.col("tx"))).alias("tx"),
            F.max(F.when(own, F.col("flagged"))).alias("flagged"),
            F.max(F.when(own, F.col("alert_rate_pct"))).alias("alert_rate_pct"),
            (F.sum("alert_rate_pct") / F.count(F.lit(1))).alias("sla_rate_pct"),
        )
        # ranks past the newest minute receive contributions but no minute
        .filter(F.col("minute").isNotNull())
        .drop("_target")
    )


def sla_verdict(rolling: DataFrame, limit_pct: float) -> DataFrame:
    """Latest rolling rate and whether it breaches (strictly above) the limit.

    No minutes → rate 0.0, no breach.
    """
    agg = rolling.agg(
        F.max("minute").alias("latest_minute"),
        F.coalesce(F.max_by("sla_rate_pct", "minute"), F.lit(0.0)).alias("sla_rate_pct"),
    )
    return agg.select(
        "latest_minute",
        round_to("sla_rate_pct", 6).alias("sla_rate_pct"),
        F.lit(float(limit_pct)).alias("limit_pct"),
        (F.col("sla_rate_pct") > F.lit(float(limit_pct))).alias("breach"),
    )


def hotspots(flagged_df: DataFrame, column: str, k: int) -> DataFrame:
    """Top ``k`` values of ``column`` by flagged count (NULLs excluded;
    ties by value ascending)."""
    return (
        flagged_df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_flagged"))
        .orderBy(F.col("n_flagged").desc(), F.col(column).asc())
        .limit(k)
    )


def filter_options(df: DataFrame, columns=("country", "merchant", "category", "customer_id")) -> DataFrame:
    """Sorted distinct non-null values of several columns, in one scan.

    Output (field, value); the distinct combines map-side.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])
    return (
        df.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .distinct()
        .orderBy("field", "value")
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram of ``column`` between its min and max.

    Two passes, each combining map-side: the bounds as one scalar subquery,
    then counts of at most ``bins`` groups. Nothing is kept per distinct
    value, of which a model's scores have as many as rows. The maximum falls
    into the last bin; empty bins are not emitted; values that are NULL, NaN
    or infinite are ignored.
    """
    values = df.select(finite(column).alias("_v")).filter(F.col("_v").isNotNull())
    v = F.col("_v")
    bounds = values.select(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()
    # bounds bound to one column: the plan holds a single subquery
    framed = values.withColumn("_b", bounds).select(
        "_v", F.col("_b.lo").alias("_lo"), ((F.col("_b.hi") - F.col("_b.lo")) / F.lit(float(bins))).alias("_w")
    )
    lo, width = F.col("_lo"), F.col("_w")
    raw = F.when(width > 0, F.floor((v - lo) / width)).otherwise(F.lit(0))
    idx = F.least(raw, F.lit(bins - 1)).cast("int")
    return (
        framed.groupBy(idx.alias("bin"), "_lo", "_w")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            round_to(lo + F.col("bin") * width, 6).alias("lower"),
            round_to(lo + (F.col("bin") + 1) * width, 6).alias("upper"),
            "n",
        )
    )
