"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.session import shared_folder

#: Rows of one Arrow batch. Texts are processed whole, so the batch is bounded
#: by rows times the longest text; the default of 10,000 is too many for texts.
BATCH_ROWS = 512

#: The bytes of ``[\x20\x09-\x0D]`` that part words.
SPACES = " \t\n\x0b\x0c\r"

BatchFn = Callable[[pa.RecordBatch], list[pa.Array]]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the session fit for tasks that read whole texts in Python: bounded
    batches, and this package sent to the executors, once an application."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name = os.path.join(tempfile.mkdtemp(prefix="txrisk-ship-"), os.path.basename(package))
        sc.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(sc.applicationId)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str = "text") -> Column:
    """The text, a null as the empty string."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def map_batches(df: DataFrame, carry: list[str], new: str, make: Callable[[], BatchFn]) -> DataFrame:
    """Append columns computed batch by batch in Python.

    ``df`` holds the columns ``carry`` and whatever the batch function reads;
    the result holds ``carry`` and the columns of the DDL string ``new``.
    ``make`` runs once in each task and returns the batch function.
    """
    ship(df.sparkSession)
    added = T.StructType.fromDDL(new)
    schema = T.StructType([df.schema[c] for c in carry] + list(added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        for batch in batches:
            fn = fn or make()
            cols = [batch.column(batch.schema.get_field_index(c)) for c in carry] + fn(batch)
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema])

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def hash_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most about ``rows`` rows, one for each key, those whose key hashes lowest.

    The share kept is ``rows`` over the row count, so what a caller collects stays
    bounded however large the table is and however often a key is repeated: a row
    without key is never sampled, and of the rows of one key only the least by its
    other columns, in their order, a minimum that combines map-side. Equal for equal
    tables.
    """
    known = df.filter(F.col(key).isNotNull())
    n = known.count()
    if n > rows:
        known = known.filter(F.pmod(F.xxhash64(F.col(key)), F.lit(2**40)) < int(2**40 * rows / n))
    others = [c for c in df.columns if c != key]
    if not others:
        return known.distinct()
    least = known.groupBy(key).agg(F.min(F.struct(*others)).alias("_least"))
    return least.select(*[F.col(key) if c == key else F.col("_least")[c].alias(c) for c in df.columns])


def folder(spark: SparkSession, within: str = "") -> str:
    """Where ``written`` puts its tables, those of one run ``within`` a folder of its own."""
    return os.path.join(shared_folder(spark), "llm", within)


def written(df: DataFrame, name: str, within: str = "") -> tuple[DataFrame, str]:
    """Cut the lineage: write the frame as a table in the shared folder and read it again."""
    spark = df.sparkSession
    path = os.path.join(folder(spark, within), f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that ``written`` made and nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def fold_mod(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n; -1 for a null key, which no fold has."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % n, F.lit(-1))
