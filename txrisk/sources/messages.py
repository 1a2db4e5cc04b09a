"""JSON transaction messages: encode, decode and quarantine.

A message is one JSON object per record (the topic's ``value``). Decoding
never fails a batch: text that is not JSON, or whose fields have the wrong
type, is kept in the corrupt-record column; rows missing a required field or
carrying an unparseable event time are routed to quarantine with a reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.columns import format_ts, parse_ts
from txrisk.schema import CORRUPT_COLUMN, MESSAGE_SCHEMA, MESSAGE_SCHEMA_WITH_CORRUPT
from txrisk.sources.transactions import TX_COLUMNS

# Quarantine reasons, in the order they are tested.
REASON_NULL_MESSAGE = "null_message"
REASON_MALFORMED = "malformed_json"
REASON_MISSING_FIELD = "missing_field"
REASON_BAD_TIMESTAMP = "bad_timestamp"
REASON_BAD_AMOUNT = "bad_amount"

REQUIRED_FIELDS = ("transaction_id", "customer_id", "ts", "amount")


def to_messages(tx: DataFrame) -> DataFrame:
    """Transactions → one ``value`` string per row, as the producer sends."""
    fields = [format_ts("ts").alias("ts") if c == "ts" else F.col(c) for c in TX_COLUMNS]
    return tx.select(F.to_json(F.struct(*fields)).alias("value"))


def decode(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """``value`` (binary or string) → message fields + ``ts_text`` + parsed ``ts``.

    Output columns: ``value`` (text), the eight message fields with ``ts``
    as TIMESTAMP_NTZ, ``ts_text`` and the corrupt-record column.

    The JSON is parsed inside a generator (``inline`` of a one-element
    array). Predicates on generator output are not pushed below it, so a
    later quarantine filter reads the parsed columns instead of re-running
    ``from_json`` once per referenced field.
    """
    text = F.col(value_col).cast("string")
    parsed = F.from_json(
        text,
        MESSAGE_SCHEMA_WITH_CORRUPT,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN},
    )
    d = raw.select(F.inline(F.array(F.struct(text.alias("value"), parsed.alias("d")))))
    return d.select(
        "value",
        *[parse_ts(F.col("d.ts")).alias("ts") if f.name == "ts" else F.col(f"d.{f.name}").alias(f.name)
          for f in MESSAGE_SCHEMA.fields],
        F.col("d.ts").alias("ts_text"),
        F.col(f"d.{CORRUPT_COLUMN}").alias(CORRUPT_COLUMN),
    )


def quarantine_reason(decoded: DataFrame) -> F.Column:
    """NULL for an acceptable row, else the first failed test.

    An amount has to be a finite number: one NaN would spread to every
    z-score of its batch. Negative amounts are accepted (refunds).
    """
    missing = F.lit(False)
    for c in REQUIRED_FIELDS:
        missing = missing | F.col("ts_text" if c == "ts" else c).isNull()
    return (
        F.when(F.col("value").isNull(), F.lit(REASON_NULL_MESSAGE))
        .when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit(REASON_MALFORMED))
        .when(missing, F.lit(REASON_MISSING_FIELD))
        .when(F.col("ts").isNull(), F.lit(REASON_BAD_TIMESTAMP))
        .when(F.isnan("amount") | (F.abs(F.col("amount")) == F.lit(float("inf"))), F.lit(REASON_BAD_AMOUNT))
    )


def with_reason(decoded: DataFrame) -> DataFrame:
    return decoded.withColumn("reason", quarantine_reason(decoded))


def split(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted transactions, quarantined rows with reason).

    Both halves come from one tagged frame; callers that use both should
    persist the tagged frame first so the source is read once.
    """
    tagged = with_reason(decoded)
    accepted = tagged.filter(F.col("reason").isNull()).select(*TX_COLUMNS)
    quarantined = tagged.filter(F.col("reason").isNotNull()).select(
        "value", "transaction_id", "ts_text", "reason"
    )
    return accepted, quarantined
