"""The scoring job run as a stream over message files made from the tables.

Messages are written in the order of a hash, one in ``REPEATED_EACH`` twice, so rows
come late, out of order and repeated. The first query is stopped by a failure between
the two table writes of its second batch; a second one goes on from its checkpoint.
"""

from __future__ import annotations

import os

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.params import ScoringParams
from txrisk.session import new_folder, session_conf
from txrisk.sources.messages import to_messages
from txrisk.streaming.job import ScoringJob, SinkPaths, start_scoring
from txrisk.streaming.source import read_transactions

#: Micro-batches that take the message files, and the files that each takes for a core.
BATCHES = 2
FILES_A_CORE = 1
REPEATED_EACH = 16
#: A state store is open while its task runs: batches are few and large here, and an
#: open store costs an executor some MB whatever it holds, so as many as the shuffle
#: has partitions, of both queries, would not fit. Nothing reads how many keys there are.
STORES = {
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


class Stopped(RuntimeError):
    """The failure that the first query is stopped by."""


class StoppedJob(ScoringJob):
    """Fails between the table writes of its second batch."""

    def write_alerts(self, out: DataFrame, batch_id: int) -> None:
        if batch_id == 1:
            raise Stopped("between the table writes")
        super().write_alerts(out, batch_id)


def files_a_batch(spark: SparkSession) -> int:
    """As many as the cores, so that the files are written and read by all of them."""
    return max(2, FILES_A_CORE * spark.sparkContext.defaultParallelism)


def message_files(tx: DataFrame, path: str) -> None:
    files = BATCHES * files_a_batch(tx.sparkSession)
    repeated = tx.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(REPEATED_EACH)) == 0)
    messages = to_messages(tx).unionByName(to_messages(repeated).withColumn("value", F.concat("value", F.lit(" "))))
    messages.repartition(files, F.xxhash64("value")).sortWithinPartitions(F.xxhash64("value")).write.text(path)


def streamed(tx: DataFrame, p: ScoringParams, minutes: bool = False) -> SinkPaths:
    """The tables that the job leaves when all message files have been read."""
    spark = tx.sparkSession
    root = new_folder(spark, "streamed")
    at = lambda name: os.path.join(root, name)
    message_files(tx, at("messages"))
    sinks = SinkPaths(at("enriched"), at("alerts"), minutes=at("minutes") if minutes else None)
    for job in (StoppedJob(sinks, params=p), ScoringJob(sinks, params=p)):
        raw = read_transactions(spark, fmt="text", path=at("messages"), max_per_trigger=files_a_batch(spark))
        with session_conf(spark, STORES):
            query = start_scoring(raw, job, at("checkpoint"), trigger={"availableNow": True}, query_name=None)
        try:
            query.awaitTermination()
        except StreamingQueryException as e:
            if "between the table writes" not in str(e):
                raise
    return sinks
