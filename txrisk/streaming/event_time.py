"""Event-time streaming operators (state kept by Spark, in RocksDB).

* ``dedupe_stream`` — at-least-once replays removed by key within the
  watermark.
* ``trailing_count_stream`` — exact per-customer count over
  ``[ts − window, ts]``: state per (customer, grain of time), no pairs. A row is
  emitted once the watermark passes its grain.
* ``minute_rates_stream`` — per-minute transactions / flagged / rate over
  a scored stream, each minute once, when the watermark closes it.
* ``start_minute_rates`` — the same without a watermark, in update mode into a
  table keyed by minute: a late row changes its minute.

Streaming ``withWatermark`` needs TIMESTAMP (not NTZ); event time is cast
with the session zone pinned to UTC.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from txrisk.functions.columns import is_flagged, minute_floor
from txrisk.sinks.keyed import write_batch


def as_event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def dedupe_stream(stream: DataFrame, watermark: str, key: str = "transaction_id", ts: str = "ts") -> DataFrame:
    return as_event_time(stream, ts).withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])


#: State of one (customer, grain): times of its own events and of those of the grain
#: before, as packed 64-bit microseconds, and the own events' other columns as JSON.
GRAIN_STATE = "own binary, rest array<string>, earlier binary"


def _grain_counts(window: int, name: str):
    """State function: gathers the events of a grain, and counts them once no more can
    come. ``name`` is what the first key is called."""

    def run(key, frames, state):
        grain = int(key[1])
        if state.hasTimedOut:
            own, rest, earlier = state.get
            state.remove()
            own, earlier = np.frombuffer(own, np.int64), np.frombuffer(earlier, np.int64)
            every = np.sort(np.concatenate([own, earlier]))
            # in [ts - window, ts]; peers are counted
            n = np.searchsorted(every, own, "right") - np.searchsorted(every, own - window, "left")
            yield pd.DataFrame({name: key[0], "us": own, "rest": list(rest), "n": n.astype(np.int32)})
            return
        own, rest, earlier = state.get if state.exists else (b"", [], b"")
        owns, rests, befores = [own], list(rest), [earlier]
        for pdf in frames:
            mine = pdf["mine"].to_numpy()
            us = pdf["us"].to_numpy(np.int64)
            owns.append(us[mine].tobytes())
            befores.append(us[~mine].tobytes())
            rests += pdf["rest"][mine].tolist()
        state.update((b"".join(owns), rests, b"".join(befores)))
        # the grain ends here; its events are all there when the watermark is past it
        state.setTimeoutTimestamp((grain + 1) * window // 1000)

    return run


def trailing_count_stream(
    stream: DataFrame,
    window_seconds: int,
    watermark: str,
    key: str = "customer_id",
    ts: str = "ts",
    out: str = "tx_count_5min",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(transaction_id, customer_id, ts, *carry, count) in append mode.

    ``carry`` names further columns of the row that are passed through.

    De-duplication comes first. Time is cut into grains as long as the window; an
    event goes to the state of its own (customer, grain) and, as a bare time, to that
    of the next grain. When the watermark passes a grain's end, its events are counted
    by two binary searches each in the sorted times of both grains: state and work grow
    with the events of two windows of a customer, not with their pairs. What comes
    later than the watermark is dropped; the scoring job, which drops nothing, doesn't
    use this operator.
    """
    w = int(window_seconds) * 1_000_000
    s = dedupe_stream(stream.select("transaction_id", key, ts, *carry), watermark, "transaction_id", ts)
    rest = F.to_json(F.struct("transaction_id", *carry))
    s = s.select(key, ts, F.unix_micros(F.col(ts)).alias("us"), rest.alias("rest"))
    grain = F.expr(f"(us - pmod(us, {w}L)) div {w}L")
    copies = F.array(F.struct(grain.alias("grain"), F.lit(True).alias("mine")), F.struct((grain + 1).alias("grain"), F.lit(False).alias("mine")))
    dealt = s.select(key, ts, "us", "rest", F.inline(copies)).withColumn("rest", F.when(F.col("mine"), F.col("rest")))
    counted = dealt.groupBy(key, "grain").applyInPandasWithState(
        _grain_counts(w, key), f"{key} string, us long, rest string, n int", GRAIN_STATE, "append", GroupStateTimeout.EventTimeTimeout)
    fields = T.StructType([stream.schema[c] for c in ("transaction_id", *carry)])
    parsed = counted.select(key, "us", "n", F.from_json("rest", fields).alias("r"))
    return parsed.select(F.col("r.transaction_id").alias("transaction_id"), key, F.timestamp_micros("us").alias(ts), *[F.col(f"r.{c}").alias(c) for c in carry], F.col("n").alias(out))


def minute_rates_stream(scored: DataFrame, threshold: float, watermark: str, ts: str = "ts") -> DataFrame:
    """Tumbling one-minute windows, emitted when the watermark closes them."""
    s = as_event_time(scored, ts).withWatermark(ts, watermark)
    agg = s.groupBy(F.window(F.col(ts), "1 minute")).agg(
        F.count("transaction_id").alias("tx"),
        F.count(F.when(is_flagged("risk_score", threshold), 1)).alias("flagged"),
    )
    return agg.select(
        F.col("window.start").cast("timestamp_ntz").alias("minute"),
        "tx",
        "flagged",
        (F.col("flagged") / F.greatest(F.col("tx").cast("double"), F.lit(1.0)) * 100.0).alias("alert_rate_pct"),
    )


def start_minute_rates(scored: DataFrame, path: str, threshold: float, checkpoint_location: str,
                       ts: str = "ts", trigger: dict | None = None) -> StreamingQuery:
    """Per-minute counts of a scored stream, kept up to date in the table at ``path``.

    Each batch writes the minutes that it changed, with their new totals;
    ``sinks.keyed.current(table, key="minute")`` has the latest of each. State is one
    row per minute of event time and has no watermark, so no row is too late.
    """
    minutes = scored.filter(F.col(ts).isNotNull()).groupBy(minute_floor(ts).alias("minute")).agg(
        F.count("transaction_id").alias("tx"), F.count(F.when(is_flagged("risk_score", threshold), 1)).alias("flagged"))

    def write(batch_df: DataFrame, batch_id: int) -> None:
        write_batch(batch_df, path, batch_id, ts_col="minute")

    writer = minutes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint_location)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
