"""The ``transactions`` view over the driver tables, and the wide fixture.

Both are plain joins; no broadcast hint is given. Catalyst broadcasts a side
only when its size statistics fall under ``autoBroadcastJoinThreshold``, and
AQE converts a sort-merge join to a broadcast one only from the measured size
of a finished shuffle stage. A dimension that grows with the data therefore
falls back to a shuffled join by itself, and AQE's skew-join rule splits a hot
customer's partition on the fact side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.sources.tables import Tables

# Column order of a transaction (message and table contract)
TX_COLUMNS = ("transaction_id", "customer_id", "ts", "amount", "currency", "merchant", "country", "category")

# Fixed values of the view: currency, customer and merchant id formats.
CURRENCY = "EUR"
CUSTOMER_PREFIX = "C"
CUSTOMER_DIGITS = 6
MERCHANT_PREFIX = "M"
MERCHANT_BUCKETS = 7


def customer_id(user_id) -> F.Column:
    """Prefix and number, padded to six digits; longer numbers stay whole."""
    text = user_id.cast("string")
    return F.concat(F.lit(CUSTOMER_PREFIX), F.lpad(text, F.greatest(F.lit(CUSTOMER_DIGITS), F.length(text)), F.lit("0")))


def normalise_amount(value) -> F.Column:
    """Floor at 1.0, round to cents; NULL stays NULL (greatest skips NULLs)."""
    return F.when(value.isNotNull(), F.round(F.greatest(F.lit(1.0), value), 2))


def with_country(fact: DataFrame, custkey: str, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """fact ⋈ customer ⋈ nation, adding ``country`` (star join).

    The fact side streams; each dimension is joined on its own key. Joining
    the two dimensions first would make the planner estimate their product
    as one side and pick the fact table to broadcast.
    """
    cust = customer.select("c_custkey", "c_nationkey")
    nat = nation.select("n_nationkey", F.col("n_name").alias("country"))
    return (
        fact.join(cust, fact[custkey] == cust["c_custkey"])
        .join(nat, F.col("c_nationkey") == nat["n_nationkey"])
        .drop("c_custkey", "c_nationkey", "n_nationkey")
    )


def transactions_from(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """events ⋈ customer ⋈ nation → the 8 transaction columns."""
    ev = events.select("event_id", "ts", "user_id", "event_type", "value", "props")
    merchant_no = F.get_json_object(F.col("props"), "$.k").try_cast("int") % F.lit(MERCHANT_BUCKETS)
    return with_country(ev, "user_id", customer, nation).select(
        F.col("event_id").cast("string").alias("transaction_id"),
        customer_id(F.col("user_id")).alias("customer_id"),
        F.col("ts"),
        normalise_amount(F.col("value")).alias("amount"),
        F.lit(CURRENCY).alias("currency"),
        F.concat(F.lit(MERCHANT_PREFIX), merchant_no.cast("string")).alias("merchant"),
        F.col("country"),
        F.col("event_type").alias("category"),
    )


def transactions(t: Tables) -> DataFrame:
    return transactions_from(
        t("events", "event_id", "ts", "user_id", "event_type", "value", "props"),
        t("customer", "c_custkey", "c_nationkey"),
        t("nation", "n_nationkey", "n_name"),
    )


def wide_transactions(t: Tables, merchant: bool = True) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ supplier ⋈ part.

    Keeps every lineitem row; amount = extended price, event time = ship
    date, merchant = supplier name, category = part type, country = the
    customer's nation. There is no row key.

    ``merchant=False`` leaves out that column and with it the join to
    supplier, one shuffle of the fact rows; it relies on every lineitem
    having exactly one supplier (the tables' foreign key).
    """
    li = t("lineitem", "l_orderkey", "l_partkey", *["l_suppkey"] * merchant, "l_extendedprice", "l_shipdate")
    od = t("orders", "o_orderkey", "o_custkey")
    pt = t("part", "p_partkey", "p_type")
    lo = li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
    out = with_country(lo, "o_custkey", t("customer", "c_custkey", "c_nationkey"), t("nation", "n_nationkey", "n_name"))
    if merchant:
        out = out.join(t("supplier", "s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    return (
        out.join(pt, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            customer_id(F.col("o_custkey")).alias("customer_id"),
            F.col("l_shipdate").alias("ts"),
            F.col("l_extendedprice").alias("amount"),
            F.lit(CURRENCY).alias("currency"),
            *([F.col("s_name").alias("merchant")] if merchant else []),
            F.col("country"),
            F.col("p_type").alias("category"),
        )
    )
