"""Spark session construction and cluster-level settings."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Where a stream keeps its state, and the memory an executor gives to it.
STATE_CONF = {
    # on the executors' disks, whatever the session has: Spark's default keeps every key on
    # the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a batch's state upload is its changes, whatever the state has grown to
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # write buffers, index and cached blocks of all stores of an executor share this much
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}

# Settings the engine relies on. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # no Python call-site capture per Column (it only decorates error text
    # and costs a stack walk on every expression built on the driver)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # checkpoint files of materialised frames are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    **STATE_CONF,
}


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 1 << 30) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of input.

    Reducers of about 1 GB and scan splits of 1 GB: 100 TB gives some 100,000
    of each, so a shuffle block is about 10 KB before push-based shuffle merges
    blocks of one reducer on their way; more, smaller partitions would only
    grow the driver's map-output table. Never fewer than 3 tasks per core. AQE
    coalesces small partitions and splits skewed join partitions.
    """
    parts = max(3 * total_cores, -(-int(input_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, max(16 << 20, int(input_bytes) // max(1, 3 * total_cores)))),
        "spark.shuffle.push.enabled": "true",
    }


def build_session(
    master: str | None = None,
    app_name: str = "txrisk",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
    total_cores: int | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    ``master`` is only set when given: on a cluster the launcher decides.
    ``input_bytes`` and ``total_cores`` size the partitions (``scale_conf``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    if input_bytes and total_cores:
        conf.update(scale_conf(input_bytes, total_cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The session with these settings, and as it was afterwards."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def pin_utc(spark: SparkSession) -> None:
    """Event time is stored without zone and read as UTC wall clock; the
    engine's conversions (ISO text, epoch microseconds for windows, minute
    floors) assume the session zone is UTC, so every query pins it."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names.

    The cluster's ``spark.checkpoint.dir`` always wins. ``fallback`` (tests,
    local runs) is used only when that setting is unset. The folder is also
    registered with the SparkContext so ``DataFrame.checkpoint()`` writes
    there (reliable checkpoints, never ``localCheckpoint``).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    path = configured or fallback
    if not path:
        raise RuntimeError("spark.checkpoint.dir is unset and no fallback was given")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where that is unset, a session in one
    JVM (tests, local runs) gets a folder of its own; on a cluster that is an error,
    as each executor would write to its own disk."""
    try:
        return checkpoint_dir(spark)
    except RuntimeError:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise
        return checkpoint_dir(spark, fallback=spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="txrisk-shared-"))


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several branches of one plan read.

    Spark re-executes a shared sub-plan once per consumer (column pruning
    makes the branches differ, so exchange reuse rarely applies). For a
    small derived table (a per-minute series, per-value counts) the frame
    is written once with a reliable ``checkpoint()`` into the shared folder
    named by ``spark.checkpoint.dir`` and read back by every branch; an
    executor lost later recomputes nothing upstream.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def streaming_checkpoint(spark: SparkSession, name: str, fallback: str | None = None) -> str:
    """Checkpoint location of a named streaming query under the shared folder."""
    root = spark.conf.get("spark.sql.streaming.checkpointLocation", None)
    if not root:
        root = checkpoint_dir(spark, fallback)
    return os.path.join(root, "streams", name)
