"""Keyed, replay-safe tables.

The original job appends to two tables with a primary key and fails on a
replayed batch. Here a table is partitioned by event date and batch id (and, where
rows have a customer, by a hash bucket of it) and a micro-batch overwrites its own
partitions only, so a batch replayed after a crash (at-least-once delivery) replaces
what it wrote the first time. A row may be written again by a later batch, as a
revision, or taken back, as a retraction (``retracted``); the current state of a key
is the row of its latest batch, none if that takes it back (``current``). Revisions
keep their event time and customer, so finding them never leaves a partition's date
and bucket, and ``touching`` reads those that a batch touches and no others.

Which keys are taken is known to the stream's state (``streaming.job``), a lookup of
the batch's own keys. Batches that come without a stream read a key table beside the
main one, partitioned by a hash bucket of the key, in the buckets of their own keys.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.schema import RETRACTED_COLUMN

PARTITION_COLUMN = "event_date"
BATCH_COLUMN = "batch_id"
BUCKET_COLUMN = "key_bucket"
CUSTOMER_COLUMN = "customer_bucket"
#: Buckets of customers within a date.
CUSTOMER_BUCKETS = 4
#: (date, bucket) pairs up to which they are broadcast to prune a read.
PRUNING_PAIRS = 100_000
#: Buckets of a key table, which bounds what a batch asks for.
KEY_BUCKETS = 256
#: What Spark says of a folder that does not exist yet, or holds no file yet.
NOTHING_WRITTEN = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None when nothing has been written yet; any
    other failure to read it is raised. With a ``schema`` (without the partition
    columns) no file footer is read for it."""
    if schema is not None:
        bucketed = "customer_id" in schema.fieldNames()
        schema = T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in _PARTITIONS.items() if bucketed or n != CUSTOMER_COLUMN]])
    try:
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in NOTHING_WRITTEN:
            return None
        raise


_PARTITIONS = {PARTITION_COLUMN: T.DateType(), CUSTOMER_COLUMN: T.IntegerType(), BATCH_COLUMN: T.LongType()}


def with_partition(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    return df.withColumn(PARTITION_COLUMN, F.to_date(F.col(ts_col)))


def one_per_key(batch: DataFrame, key: str = "transaction_id") -> DataFrame:
    """One row per key: the smallest of unequal copies by all columns in order,
    so that a replay picks the same one. Combines map-side."""
    others = [c for c in batch.columns if c != key]
    best = batch.groupBy(key).agg(F.min(F.struct(*others)).alias("_row"))
    return best.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in batch.columns])


def new_rows(batch: DataFrame, taken: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows of ``batch``, one per key, whose key is not among the ``taken`` ones."""
    return one_per_key(batch, key).join(taken.select(key), on=key, how="left_anti")


def current(table: DataFrame, key: str = "transaction_id") -> DataFrame:
    """One row per key, the latest batch's; none where that row is a retraction."""
    others = [c for c in table.columns if c not in (key, BATCH_COLUMN)]
    best = table.groupBy(key).agg(F.max(F.struct(BATCH_COLUMN, *others)).alias("_row"))
    rows = best.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in table.columns])
    return rows.filter(~F.col(RETRACTED_COLUMN)).drop(RETRACTED_COLUMN) if RETRACTED_COLUMN in table.columns else rows


def customer_bucket(customer: str = "customer_id") -> F.Column:
    return F.pmod(F.xxhash64(F.col(customer)), F.lit(CUSTOMER_BUCKETS)).cast("int")


def touching(table: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of the table in the (event date, customer bucket) partitions of ``pairs``.

    The pairs are broadcast, and Spark prunes the scan's partitions by them at run
    time. They are counted first: beyond ``PRUNING_PAIRS`` (dates of some 70 years in
    one batch) the same join is left to be shuffled, and reads all partitions.
    """
    # the comparison makes the pairs a filter in the eyes of the pruning rule
    pairs = pairs.select(PARTITION_COLUMN, CUSTOMER_COLUMN).distinct().filter(F.col(CUSTOMER_COLUMN) >= 0)
    if pairs.count() <= PRUNING_PAIRS:
        pairs = F.broadcast(pairs)
    return table.join(pairs, [PARTITION_COLUMN, CUSTOMER_COLUMN], "left_semi")


def key_bucket(key: str = "transaction_id") -> F.Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(KEY_BUCKETS)).cast("int")


def keys_path(path: str) -> str:
    return path.rstrip("/") + ".keys"


def taken_keys(batch: DataFrame, path: str, batch_id: int, key: str = "transaction_id") -> DataFrame | None:
    """Keys that other batches wrote to the table at ``path``, in the buckets
    of this batch's keys. At most ``KEY_BUCKETS`` numbers reach the driver."""
    keys = read_table(batch.sparkSession, keys_path(path))
    if keys is None:
        return None
    buckets = [r[0] for r in batch.select(key_bucket(key)).distinct().collect()]
    return keys.filter(F.col(BUCKET_COLUMN).isin(buckets) & (F.col(BATCH_COLUMN) != F.lit(int(batch_id)))).select(key)


def _overwrite(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int, ts_col: str = "ts") -> None:
    """Write the batch's rows, replacing what an earlier attempt of the same
    batch wrote. Rows are gathered by their partition first, where a large one
    (a hot customer's) is split over tasks: about a file per partition."""
    out = with_partition(df, ts_col).withColumn(BATCH_COLUMN, F.lit(int(batch_id)).cast("long"))
    parts = [PARTITION_COLUMN]
    if "customer_id" in df.columns:
        out = out.withColumn(CUSTOMER_COLUMN, customer_bucket())
        parts.append(CUSTOMER_COLUMN)
    _overwrite(out.hint("rebalance", *parts), path, *parts, BATCH_COLUMN)


def write_keys(df: DataFrame, path: str, batch_id: int, key: str = "transaction_id") -> None:
    out = df.select(key, key_bucket(key).alias(BUCKET_COLUMN), F.lit(int(batch_id)).cast("long").alias(BATCH_COLUMN))
    _overwrite(out.repartition(BUCKET_COLUMN), keys_path(path), BUCKET_COLUMN, BATCH_COLUMN)


def write_batch_partition(df: DataFrame, path: str, batch_id: int) -> None:
    """Unkeyed rows such as quarantined messages, in the batch's own partition."""
    _overwrite(df.withColumn(BATCH_COLUMN, F.lit(int(batch_id))), path, BATCH_COLUMN)


def write_keyed_jdbc(df: DataFrame, url: str, table: str, properties: dict, key: str = "transaction_id") -> None:
    """JDBC form of the keyed append: the batch goes to a staging table, the
    keys already in the target are read back for the staged keys only
    (the join runs in the database), and the remaining rows are appended.

    Not exercised by the tests: no database may be started here.
    """
    staging = f"{table}_staging"
    batch = one_per_key(df, key)
    batch.write.jdbc(url=url, table=staging, mode="overwrite", properties=properties)
    present_sql = f"(SELECT t.{key} FROM {table} t JOIN {staging} s ON t.{key} = s.{key}) present"
    present = df.sparkSession.read.jdbc(url=url, table=present_sql, properties=properties)
    batch.join(present, on=key, how="left_anti").write.jdbc(url=url, table=table, mode="append", properties=properties)
