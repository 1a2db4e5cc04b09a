"""Batch table sources.

Tables are read as parquet with a declared schema restricted to the
columns a query needs: no schema-inference job reads file footers before
planning (at scale: thousands of files), and the scan's ``ReadSchema``
carries only those columns.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


# Declared column types of the tables the engine reads.
TABLE_SCHEMAS: dict[str, dict[str, str]] = {
    "events": {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
               "value": "double", "props": "string"},
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
                 "c_mktsegment": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "region": {"r_regionkey": "int", "r_name": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "part": {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string",
             "p_size": "int", "p_retailprice": "double"},
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
               "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
    "lineitem": {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
                 "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
                 "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"},
}


def schema_ddl(name: str, columns: list[str] | None = None) -> str | None:
    """DDL of the declared columns of ``name`` (all, or the given ones)."""
    cols = TABLE_SCHEMAS.get(name)
    if cols is None:
        return None
    wanted = columns or list(cols)
    return ", ".join(f"{c} {cols[c]}" for c in wanted)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read one table; ``columns`` narrows the scan."""
    ddl = schema_ddl(name, columns)
    if ddl is not None:
        return spark.read.schema(ddl).parquet(table_path(sf_dir, name))
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


class Tables:
    """Lazy accessor over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __call__(self, name: str, *columns: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name, list(columns) or None)
