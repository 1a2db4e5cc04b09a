"""Expected-value economics of a threshold: cost model, sweep, best threshold.

The score is read as a fraud probability (clipped to [0, 1]), summed in
integer millionths so that every total is exact. For a threshold t, with
F = flagged rows and p = clipped score:

* expected frauds flagged  = Σ_F p          expected FP = |F| − Σ_F p
* expected frauds missed   = Σ_all p − Σ_F p
* avoided losses           = Σ_F p · efficiency · loss
* costs                    = |F| · review + FP · fp_cost
* net value                = avoided − costs
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.functions.columns import at_least, clip01, is_flagged, round_to
from txrisk.params import CostParams, SweepParams


MICRO = 1_000_000


def _prob(score: str = "risk_score") -> F.Column:
    """Clipped score; NaN treated as missing (skipped by sums)."""
    s = F.col(score)
    return clip01(F.when(~F.isnan(s), s))


def _micro(p: F.Column) -> F.Column:
    """Probability in integer millionths. Sums of these are exact, so the
    expected counts do not depend on summation order (tasks, engines)."""
    return F.round(p * F.lit(float(MICRO))).cast("long")


def _mass(micro_sum: F.Column) -> F.Column:
    return F.coalesce(micro_sum, F.lit(0)) / F.lit(float(MICRO))


def _value_columns(n_flag: F.Column, p_flag: F.Column, p_all: F.Column, c: CostParams) -> dict[str, F.Column]:
    fp = n_flag - p_flag
    avoided = p_flag * F.lit(c.block_efficiency) * F.lit(c.loss_per_fraud)
    costs = n_flag * F.lit(c.review_cost) + fp * F.lit(c.false_positive_cost)
    return {
        "precision_est": p_flag / at_least(n_flag, 1),
        "recall_est": p_flag / at_least(p_all, 1e-9),
        "expected_fp": fp,
        "avoided_losses_est": avoided,
        "costs_est": costs,
        "net_value_est": avoided - costs,
    }


def cost_model(df: DataFrame, threshold: float, c: CostParams) -> DataFrame:
    """One row of expected counts and money at ``threshold`` (one scan)."""
    flag = is_flagged("risk_score", threshold)
    agg = df.agg(
        F.count(F.lit(1)).alias("n_tx"),
        F.count(F.when(flag, 1)).alias("n_flagged"),
        _mass(F.sum(_micro(_prob()))).alias("expected_total_fraud"),
        _mass(F.sum(F.when(flag, _micro(_prob())))).alias("expected_fraud_flagged"),
    )
    v = _value_columns(F.col("n_flagged"), F.col("expected_fraud_flagged"), F.col("expected_total_fraud"), c)
    return agg.select(
        "n_tx",
        "n_flagged",
        round_to("expected_total_fraud", 6).alias("expected_total_fraud"),
        round_to("expected_fraud_flagged", 6).alias("expected_fraud_flagged"),
        round_to(v["expected_fp"], 6).alias("expected_fp_flagged"),
        round_to(F.col("expected_total_fraud") - F.col("expected_fraud_flagged"), 6).alias("expected_missed_fraud"),
        round_to(F.col("expected_fraud_flagged") * F.lit(c.block_efficiency), 6).alias("expected_stopped_fraud"),
        round_to(v["avoided_losses_est"], 6).alias("avoided_losses_est"),
        round_to(v["costs_est"], 6).alias("costs_est"),
        round_to(v["net_value_est"], 6).alias("net_value_est"),
    )


def grid_index(score: F.Column, s: SweepParams) -> F.Column:
    """Largest grid index i with score >= i/scale, clamped to [lo − 1, hi].

    ``floor(score · scale)`` alone is wrong for scores such as 0.29 or 0.57,
    whose product lands just below the integer; the estimate is corrected
    by one step either way with the exact comparison ``score >= i/scale``,
    the same test a per-threshold filter would make. NaN / NULL → lo − 1
    (never flagged).
    """
    scale = F.lit(float(s.scale))
    # clamping to one step outside the grid keeps every comparison with a
    # grid threshold and keeps floor() in range (ANSI raises on overflow)
    bounded = F.least(F.greatest(score, F.lit((s.lo - 1) / s.scale)), F.lit((s.hi + 1) / s.scale))
    c0 = F.floor(bounded * scale)
    up = F.when(bounded >= (c0 + 1) / scale, 1).otherwise(0)
    down = F.when(bounded < c0 / scale, 1).otherwise(0)
    i = c0 + up - down
    clamped = F.least(F.greatest(i, F.lit(s.lo - 1)), F.lit(s.hi))
    return F.when(score.isNull() | F.isnan(score), F.lit(s.lo - 1)).otherwise(clamped).cast("int")


def threshold_sweep(df: DataFrame, s: SweepParams, c: CostParams) -> DataFrame:
    """Expected precision, recall and money at every grid threshold.

    One scan: each row maps to its grid index, one map-side-combined
    aggregation reduces the data to at most ``hi − lo + 2`` rows, and
    reverse running sums over that tiny table give the flagged count and
    flagged probability mass at each threshold (flagged at t_i ⇔ index ≥ i).
    """
    spark: SparkSession = df.sparkSession
    buckets = (
        df.select(grid_index(F.col("risk_score"), s).alias("i"), _micro(_prob()).alias("p"))
        .groupBy("i")
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("p"), F.lit(0)).alias("sp"))
    )
    # grid lo − 1 … hi; index lo − 1 holds the never-flagged rows
    grid = spark.range(s.lo - 1, s.hi + 1).select(F.col("id").cast("int").alias("i"))
    per_i = grid.join(buckets, on="i", how="left").select(
        "i", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("sp", F.lit(0)).alias("sp")
    )
    # windows over the grid table: hi − lo + 2 rows (51 by default)
    rev = Window.orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cum = per_i.select(
        "i",
        F.sum("n").over(rev).alias("flagged"),
        _mass(F.sum("sp").over(rev)).alias("p_flag"),
        _mass(F.sum("sp").over(whole)).alias("p_all"),
    ).filter(F.col("i") >= F.lit(s.lo))
    v = _value_columns(F.col("flagged"), F.col("p_flag"), F.col("p_all"), c)
    return cum.select(
        (F.col("i") / F.lit(float(s.scale))).alias("threshold"),
        F.col("flagged").cast("long").alias("flagged"),
        round_to(v["precision_est"], 6).alias("precision_est"),
        round_to(v["recall_est"], 6).alias("recall_est"),
        round_to(v["net_value_est"], 6).alias("net_value_est"),
        round_to(v["avoided_losses_est"], 6).alias("avoided_losses_est"),
        round_to(v["costs_est"], 6).alias("costs_est"),
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Grid point of maximum net value (ties: lowest threshold)."""
    return sweep.orderBy(F.col("net_value_est").desc(), F.col("threshold").asc()).limit(1)
