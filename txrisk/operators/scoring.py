"""Risk scores: the fixed linear score, a fitted pipeline, or its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.columns import linear_score
from txrisk.operators.features import COUNT_COLUMN, amount_zscore, features
from txrisk.params import ScoringParams
from txrisk.schema import ENRICHED_SCHEMA, assert_schema

SCORE_COLUMN = "risk_score"


def score_linear(df: DataFrame, p: ScoringParams, count_col: str = COUNT_COLUMN) -> DataFrame:
    """Adds ``risk_score`` = sigmoid of the fixed coefficients, rounded."""
    return df.withColumn(
        SCORE_COLUMN, linear_score("amount", count_col, "is_foreign", "category", p)
    )


def score_transactions(tx: DataFrame, p: ScoringParams) -> DataFrame:
    """transactions → features → trailing count → score."""
    return score_linear(features(tx, p), p)


def enriched(scored: DataFrame) -> DataFrame:
    """The 11-column enriched table (contract checked)."""
    out = amount_zscore(scored).select(*[f.name for f in ENRICHED_SCHEMA.fields])
    return assert_schema(out, ENRICHED_SCHEMA)


def probability_of_class1(scored: DataFrame, probability_col: str = "probability",
                          out: str = SCORE_COLUMN) -> DataFrame:
    """Class-1 element of an ML probability vector, JVM-side."""
    from pyspark.ml.functions import vector_to_array

    return scored.withColumn(out, vector_to_array(F.col(probability_col))[1])
