"""Table contracts: message, enriched and alert schemas, and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"

# Raw message: eight nullable fields, event time as text.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType(), True),
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("ts", T.StringType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("currency", T.StringType(), True),
    T.StructField("merchant", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
])

# Message schema plus the column where from_json keeps unparseable text.
MESSAGE_SCHEMA_WITH_CORRUPT = T.StructType(
    MESSAGE_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
)

ENRICHED_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType(), True),
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("currency", T.StringType(), True),
    T.StructField("merchant", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("tx_count_5min", T.IntegerType(), True),
    T.StructField("amount_zscore", T.DoubleType(), True),
    T.StructField("risk_score", T.DoubleType(), True),
])

ALERT_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("risk_score", T.DoubleType(), True),
    T.StructField("reason", T.StringType(), True),
    T.StructField("severity", T.StringType(), True),
])

#: What the alert table holds beside an alert: whether the row takes it back.
RETRACTED_COLUMN = "retracted"
ALERT_TABLE_SCHEMA = T.StructType(ALERT_SCHEMA.fields + [T.StructField(RETRACTED_COLUMN, T.BooleanType(), True)])

KEY = "transaction_id"


class ContractError(ValueError):
    pass


def assert_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Fail fast when names or types differ (nullability is not checked)."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    if got != want:
        raise ContractError(f"schema mismatch:\n got  {got}\n want {want}")
    return df
