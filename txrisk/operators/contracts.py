"""Key checks of the keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """One row: rows, distinct non-null keys, NULL keys, keys seen twice or more.

    Two map-side-combined aggregations; no row leaves its task whole.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_rows"),
        F.count(key).alias("n_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).cast("long").alias("n_null_keys"),
        F.count(F.when(F.col(key).isNotNull() & (F.col("_n") > 1), 1)).alias("n_duplicate_keys"),
    )
