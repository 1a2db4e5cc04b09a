"""Micro-batch scoring job (``foreachBatch``).

Per batch: decode → quarantine → one row per key, none that is stored already →
count → score → enriched table → changes of the alert table → quarantine table.
The transform is the same DataFrame code as the batch queries, and every write
replaces the batch's own partitions, so a replayed batch leaves the same tables.

Count modes:

* ``"batch"`` — rows of the customer within the micro-batch (the original
  job's proxy for a 5-minute count).
* ``"trailing"`` (default) — event-time trailing window over all rows stored so
  far, in whatever order they come: the batch is counted together with what is
  stored of its customers around its events. Time is cut into grains as long as the
  window; a stored row counts for a batch's row, or is counted anew because of it,
  only if it is in the same grain, the one before or the one after. So a batch reads
  the partitions of those grains' dates and customers, however far apart its events
  are. A stored row whose count a late row raises is scored anew and written as a
  revision (see ``sinks.keyed.current``), so once all rows have come, all counts are
  those of the batch query. No row is dropped as late.

A revision that takes a row over the alert threshold writes its alert; one that takes
it below (the count may weigh negatively) writes a retraction, so the current alerts
are those of the current enriched rows.

``start_scoring`` keeps the keys that have been stored in the stream's state: a batch
asks for its own keys, whatever has been stored before. ``ScoringJob.process`` without
a stream asks the key table.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txrisk.functions.columns import at_least, epoch_micros, is_flagged, linear_score, minute_floor
from txrisk.operators.alerts import build_alerts
from txrisk.operators.features import COUNT_COLUMN, amount_zscore, base_features, batch_customer_count
from txrisk.operators.features import counted as trailing
from txrisk.operators.scoring import SCORE_COLUMN
from txrisk.params import ScoringParams
from txrisk.schema import ALERT_SCHEMA, ENRICHED_SCHEMA, RETRACTED_COLUMN, assert_schema
from txrisk.session import STATE_CONF, session_conf
from txrisk.sinks.keyed import (
    BATCH_COLUMN,
    CUSTOMER_COLUMN,
    PARTITION_COLUMN,
    current,
    customer_bucket,
    new_rows,
    one_per_key,
    read_table,
    taken_keys,
    touching,
    write_batch,
    write_batch_partition,
    write_keys,
)
from txrisk.sources import messages
from txrisk.sources.transactions import TX_COLUMNS


#: What the queries on a batch are planned with, whatever the stream's session has.
BATCH_CONF = {
    "spark.sql.adaptive.enabled": "true",
    # cached frames have as many partitions as their rows need
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """AQE for the queries on a batch. Spark turns it off in the session of a stream
    with state, whose number of partitions is fixed; the batch's own queries have no
    state. Without it a ``rebalance`` hint is no exchange: each task would write a
    file to each partition of a table, and every stage have the session's number of
    shuffle partitions, however few its rows."""
    with session_conf(spark, BATCH_CONF):
        yield


@dataclass
class SinkPaths:
    enriched: str
    alerts: str
    quarantine: str | None = None
    # changes of the per-minute counts; see ``minute_totals``
    minutes: str | None = None


@dataclass
class ScoringJob:
    sinks: SinkPaths
    params: ScoringParams = field(default_factory=ScoringParams)
    count_mode: str = "trailing"
    # optional fitted PipelineModel; default is the linear score
    model: object | None = None
    # ids of the last batches, for progress reports
    batches_seen: deque = field(default_factory=lambda: deque(maxlen=100))

    # ----------------------------------------------------------- transform
    def unseen(self, accepted: DataFrame, batch_id: int) -> DataFrame:
        """One row per transaction id that no other batch has stored."""
        taken = taken_keys(accepted, self.sinks.enriched, batch_id)
        return one_per_key(accepted) if taken is None else new_rows(accepted, taken)

    def counted(self, tx: DataFrame, batch_id: int) -> DataFrame:
        """Features and count of the batch's rows, and of the stored rows whose
        count they raise: those have ``_revised`` set, their z-score in ``_z`` and
        their stored score in ``_was``."""
        p = self.params
        # from the batch's rows alone, before they meet stored ones
        tx = amount_zscore(tx, out="_z")
        own = {"_revised": F.lit(False), "_was": F.lit(None).cast("double")}
        if self.count_mode == "batch":
            out = batch_customer_count(base_features(tx, p), out="_n")
            return out.withColumn(COUNT_COLUMN, F.col("_n").cast("int")).drop("_n").withColumns(own)
        if self.count_mode != "trailing":
            raise ValueError(f"unknown count mode {self.count_mode!r}")
        both = tx.withColumns(own | {"_stored": F.lit(None).cast("int")})
        stored = self._stored_around(tx, batch_id)
        if stored is not None:
            both = both.unionByName(stored)
        out = trailing(base_features(both, p), p)
        return out.filter(~F.col("_revised") | (F.col("_stored") != F.col(COUNT_COLUMN))).drop("_stored")

    def _stored_around(self, tx: DataFrame, batch_id: int) -> DataFrame | None:
        """Current stored rows of the batch's customers in the grains of its events
        and those beside them. ``_stored`` is the stored count of those in an event's
        own grain or the one after, the ones that the batch may raise: all rows of
        their windows are here. What this batch wrote in an earlier attempt is left out."""
        table = read_table(tx.sparkSession, self.sinks.enriched, ENRICHED_SCHEMA)
        if table is None:
            return None
        grain_micros = self.params.window_micros
        us = epoch_micros("ts")
        grain = ((us - F.pmod(us, F.lit(grain_micros))) / F.lit(grain_micros)).cast("long")
        beside = F.inline(F.array(*[F.struct((F.col("_own") + d).alias("_grain"), F.lit(d >= 0).alias("_may")) for d in (-1, 0, 1)]))
        around = tx.select("customer_id", grain.alias("_own")).distinct().select("customer_id", beside)
        around = around.groupBy("customer_id", "_grain").agg(F.max("_may").alias("_may"))
        day = lambda g: F.to_date(F.timestamp_micros(g * F.lit(grain_micros)))
        days = F.explode(F.sequence(day(F.col("_grain")), day(F.col("_grain") + 1))).alias(PARTITION_COLUMN)
        near = touching(table, around.select(days, customer_bucket().alias(CUSTOMER_COLUMN)))
        near = near.filter(F.col(BATCH_COLUMN) != F.lit(int(batch_id))).withColumn("_grain", grain)
        near = near.join(around, ["customer_id", "_grain"], "inner").drop("_grain")
        may_rise = F.when(F.col("_may"), F.col(COUNT_COLUMN))
        return current(near).select(*TX_COLUMNS, F.lit(True).alias("_revised"), F.col("amount_zscore").alias("_z"),
                                    F.col(SCORE_COLUMN).alias("_was"), may_rise.alias("_stored"))

    def score(self, counted: DataFrame) -> DataFrame:
        if self.model is None:
            p = self.params
            return counted.withColumn(
                SCORE_COLUMN, linear_score("amount", COUNT_COLUMN, "is_foreign", "category", p)
            )
        from txrisk.operators.model import score_model

        return score_model(self.model, counted)

    # ------------------------------------------------------------- per batch
    def write_scored(self, scored: DataFrame, batch_id: int) -> None:
        """Enriched rows, then the changes of the alert table that follow from them.

        z-scores are those of the batch a row came in; a revision keeps its own.
        """
        names = [f.name for f in ENRICHED_SCHEMA.fields]
        out = scored.withColumn("amount_zscore", F.col("_z")).select(*names, "_was").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(assert_schema(out.select(*names), ENRICHED_SCHEMA), self.sinks.enriched, batch_id)
            self.write_alerts(out, batch_id)
            self.write_minutes(out, batch_id)
        finally:
            out.unpersist()

    def write_alerts(self, out: DataFrame, batch_id: int) -> None:
        """Alerts of the rows that are flagged, and retractions of those that were
        when they were stored and are no longer."""
        t = self.params.alert_threshold
        raised = build_alerts(out, self.params).withColumn(RETRACTED_COLUMN, F.lit(False))
        gone = out.filter(is_flagged("_was", t) & ~F.coalesce(is_flagged(SCORE_COLUMN, t), F.lit(False)))
        kept = ("transaction_id", "ts", SCORE_COLUMN)
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in ALERT_SCHEMA.fields if f.name not in kept]
        gone = gone.select(*kept, *empty, F.lit(True).alias(RETRACTED_COLUMN))
        write_batch(raised.unionByName(gone), self.sinks.alerts, batch_id)

    def write_minutes(self, out: DataFrame, batch_id: int) -> None:
        """What the batch adds to each minute's counts: its new rows, and the flags
        that revisions gain or lose. Late rows add to their own minute."""
        if not self.sinks.minutes:
            return
        flag = lambda c: F.coalesce(is_flagged(c, self.params.alert_threshold), F.lit(False)).cast("int")
        change = out.groupBy(minute_floor("ts").alias("minute")).agg(
            F.count_if(F.col("_was").isNull()).alias("tx"), F.sum(flag(SCORE_COLUMN) - flag("_was")).alias("flagged"))
        write_batch(change, self.sinks.minutes, batch_id, ts_col="minute")

    def write_rejected(self, tagged: DataFrame, batch_id: int) -> None:
        if self.sinks.quarantine:
            bad = tagged.filter(F.col("reason").isNotNull()).select("value", "transaction_id", "ts_text", "reason")
            write_batch_partition(bad, self.sinks.quarantine, batch_id)

    def process(self, batch_df: DataFrame, batch_id: int) -> None:
        """One batch of messages, without a stream: its new keys are those that the
        key table beside the enriched table doesn't hold."""
        tagged = messages.with_reason(messages.decode(batch_df)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if tagged.isEmpty():
                return
            accepted = tagged.filter(F.col("reason").isNull()).select(*TX_COLUMNS)
            tx = self.unseen(accepted, batch_id).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                self.write_scored(self.score(self.counted(tx, batch_id)), batch_id)
                write_keys(tx, self.sinks.enriched, batch_id)
            finally:
                tx.unpersist()
            self.write_rejected(tagged, batch_id)
            self.batches_seen.append(batch_id)
        finally:
            tagged.unpersist()

    def process_tagged(self, batch_df: DataFrame, batch_id: int) -> None:
        """One batch of ``tagged_stream``: its new keys are the batch's ``fresh`` rows."""
        with adaptive(batch_df.sparkSession):
            self._process_tagged(batch_df, batch_id)

    def _process_tagged(self, batch_df: DataFrame, batch_id: int) -> None:
        batch = batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            tagged = batch.filter("not fresh")
            accepted = tagged.filter(F.col("reason").isNull()).select(*TX_COLUMNS)
            fresh = batch.filter("fresh").select("transaction_id")
            tx = one_per_key(accepted).join(fresh, "transaction_id", "left_semi").persist(StorageLevel.MEMORY_AND_DISK)
            try:
                self.write_scored(self.score(self.counted(tx, batch_id)), batch_id)
            finally:
                tx.unpersist()
            self.write_rejected(tagged, batch_id)
            self.batches_seen.append(batch_id)
        finally:
            batch.unpersist()


def minute_totals(changes: DataFrame) -> DataFrame:
    """Per minute: transactions, flagged, rate %, of the ``minutes`` table; equal to
    ``monitor.minute_rates`` of the current enriched rows, in whatever order they came."""
    sums = changes.groupBy("minute").agg(F.sum("tx").alias("tx"), F.sum("flagged").alias("flagged"))
    return sums.withColumn("alert_rate_pct", F.col("flagged") / at_least("tx", 1) * 100.0)


def tagged_stream(raw_stream: DataFrame) -> DataFrame:
    """Decoded messages with their quarantine reason, and a row ``fresh`` for every
    accepted key that the stream's state has not seen in an earlier batch. The state
    holds keys only, so which copy of a key is stored is for the batch to say, and a
    replay says the same."""
    tagged = messages.with_reason(messages.decode(raw_stream))
    keys = tagged.filter(F.col("reason").isNull()).select("transaction_id").dropDuplicates()
    return tagged.withColumn("fresh", F.lit(False)).unionByName(keys.withColumn("fresh", F.lit(True)), allowMissingColumns=True)


def start_quarantine(raw_stream: DataFrame, path: str, checkpoint_location: str,
                     trigger: dict | None = None) -> StreamingQuery:
    """Rejected messages with their reason, one partition per batch id."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        bad = messages.with_reason(messages.decode(batch_df)).filter(F.col("reason").isNotNull())
        write_batch_partition(bad.select("value", "transaction_id", "ts_text", "reason"), path, batch_id)

    writer = raw_stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_location)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_scoring(
    raw_stream: DataFrame,
    job: ScoringJob,
    checkpoint_location: str,
    trigger: dict | None = None,
    query_name: str | None = "txrisk_scoring",
) -> StreamingQuery:
    """Start the micro-batch job. ``trigger`` is passed to
    ``DataStreamWriter.trigger`` (e.g. ``{"processingTime": "5 seconds"}``
    or ``{"availableNow": True}``); offsets and the state of taken keys are
    committed to ``checkpoint_location`` after both table writes return."""
    writer = (
        tagged_stream(raw_stream).writeStream.foreachBatch(job.process_tagged)
        .option("checkpointLocation", checkpoint_location)
    )
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    # a query keeps the settings that its session has when it starts
    with session_conf(raw_stream.sparkSession, STATE_CONF):
        return writer.start()
