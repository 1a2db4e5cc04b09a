"""Structured Streaming: batch = stream, replay safety, event-time operators."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from txrisk.operators.contracts import key_violations
from txrisk.operators.scoring import score_transactions
from txrisk.params import ScoringParams
from txrisk.sources.messages import to_messages
from txrisk.sources.tables import Tables
from txrisk.sources.transactions import transactions
from txrisk.streaming import event_time
from txrisk.streaming.job import ScoringJob, SinkPaths, start_scoring
from txrisk.streaming.source import read_transactions


# The file source takes files in modification-time order; each new file is
# stamped 10 s after the previous one so that order equals event-time order,
# as a topic partition would deliver it.
_MTIME = [1_600_000_000]


def write_lines(folder: str, name: str, lines: list[str]) -> None:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    _MTIME[0] += 10
    os.utime(path, (_MTIME[0], _MTIME[0]))


def message_files(spark, folder: str, parts: int = 3) -> int:
    """The sf0.001 transactions as JSON lines, split by time into files."""
    tx = transactions(Tables(spark, SMALL)).orderBy("ts", "transaction_id")
    msgs = [r.value for r in to_messages(tx).collect()]
    step = (len(msgs) + parts - 1) // parts
    for i in range(parts):
        write_lines(folder, f"part-{i:03d}.json", msgs[i * step:(i + 1) * step])
    return len(msgs)


def table(spark, path):
    """The current rows, without the partition columns."""
    from txrisk.sinks.keyed import current, read_table

    return current(read_table(spark, path)).drop("event_date", "batch_id")


def run_available(raw, job, ckpt):
    q = start_scoring(raw, job, ckpt, trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None


def test_stream_equals_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    n = message_files(spark, src, parts=3)
    sinks = SinkPaths(os.path.join(scratch, "enriched"), os.path.join(scratch, "alerts"), os.path.join(scratch, "q"))
    job = ScoringJob(sinks, params=ScoringParams.fixture())
    raw = read_transactions(spark, fmt="text", path=src, max_per_trigger=1)
    run_available(raw, job, os.path.join(scratch, "ckpt"))
    assert len(job.batches_seen) == 3

    enriched = table(spark, sinks.enriched)
    assert enriched.count() == n
    assert key_violations(enriched).first().n_duplicate_keys == 0

    batch = score_transactions(transactions(Tables(spark, SMALL)), ScoringParams.fixture())
    want = rows(batch, "transaction_id", "tx_count_5min", "risk_score")
    got = rows(enriched, "transaction_id", "tx_count_5min", "risk_score")
    assert got == want

    alerts = table(spark, sinks.alerts)
    want_alerts = rows(batch.filter(F.col("risk_score") >= 0.8), "transaction_id")
    assert rows(alerts, "transaction_id") == want_alerts
    # alerts ⊆ enriched
    assert alerts.join(enriched, "transaction_id", "left_anti").count() == 0


def test_replayed_batch_writes_nothing_twice(spark, scratch):
    src = os.path.join(scratch, "in")
    message_files(spark, src, parts=1)
    sinks = SinkPaths(os.path.join(scratch, "enriched"), os.path.join(scratch, "alerts"), os.path.join(scratch, "q"))
    job = ScoringJob(sinks, params=ScoringParams.fixture())
    batch = spark.read.text(src)
    job.process(batch, 0)
    first = rows(table(spark, sinks.enriched), "transaction_id", "tx_count_5min")
    job.process(batch, 0)
    again = table(spark, sinks.enriched)
    assert key_violations(again).first().n_duplicate_keys == 0
    assert rows(again, "transaction_id", "tx_count_5min") == first
    assert key_violations(table(spark, sinks.alerts)).first().n_duplicate_keys == 0


class FlakyJob(ScoringJob):
    """Fails once between the enriched and the alert write."""

    failed = False

    def write_alerts(self, out, batch_id):
        if not FlakyJob.failed:
            FlakyJob.failed = True
            raise RuntimeError("crash between sinks")
        super().write_alerts(out, batch_id)


def test_restart_after_crash_between_sinks(spark, scratch):
    src = os.path.join(scratch, "in")
    n = message_files(spark, src, parts=2)
    sinks = SinkPaths(os.path.join(scratch, "enriched"), os.path.join(scratch, "alerts"))
    ckpt = os.path.join(scratch, "ckpt")
    raw = read_transactions(spark, fmt="text", path=src, max_per_trigger=1)
    q = start_scoring(raw, FlakyJob(sinks, params=ScoringParams.fixture()), ckpt, trigger={"availableNow": True})
    with pytest.raises(Exception):
        q.awaitTermination(300)
    # restart from the checkpoint: the failed batch is replayed
    run_available(read_transactions(spark, fmt="text", path=src, max_per_trigger=1), ScoringJob(sinks, params=ScoringParams.fixture()), ckpt)
    enriched = table(spark, sinks.enriched)
    assert enriched.count() == n
    assert key_violations(enriched).first().n_duplicate_keys == 0
    batch = score_transactions(transactions(Tables(spark, SMALL)), ScoringParams.fixture())
    assert table(spark, sinks.alerts).count() == batch.filter(F.col("risk_score") >= 0.8).count()


def test_batch_count_mode_is_per_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    message_files(spark, src, parts=1)
    sinks = SinkPaths(os.path.join(scratch, "enriched"), os.path.join(scratch, "alerts"))
    ScoringJob(sinks, count_mode="batch").process(spark.read.text(src), 0)
    got = table(spark, sinks.enriched)
    per_customer = got.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.min("tx_count_5min").alias("lo"),
                                                  F.max("tx_count_5min").alias("hi"))
    assert per_customer.filter((F.col("n") != F.col("lo")) | (F.col("n") != F.col("hi"))).count() == 0


def _msg(tid, cust, ts):
    return json.dumps({"transaction_id": tid, "customer_id": cust, "ts": ts.isoformat() + "+00:00", "amount": 10.0})


def test_event_time_trailing_count_with_duplicates(spark, scratch):
    src = os.path.join(scratch, "in")
    t0 = dt.datetime(2026, 2, 8, 0, 0, 0)
    write_lines(src, "a.json", [_msg("a", "C1", t0), _msg("b", "C1", t0 + dt.timedelta(minutes=5))])
    write_lines(src, "b.json", [_msg("b", "C1", t0 + dt.timedelta(minutes=5)),
                                _msg("c", "C1", t0 + dt.timedelta(minutes=5, seconds=1))])
    # far-future row advances the watermark so every real row is emitted
    write_lines(src, "c.json", [_msg("z", "C9", t0 + dt.timedelta(days=1))])
    from txrisk.sources.messages import decode

    raw = read_transactions(spark, fmt="text", path=src, max_per_trigger=1)
    dec = decode(raw).select("transaction_id", "customer_id", "ts")
    counts = event_time.trailing_count_stream(dec, 300, "10 minutes")
    name = "t3_" + os.path.basename(scratch).replace("-", "_")
    q = (counts.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = rows(spark.table(name).filter("customer_id = 'C1'"), "transaction_id", "tx_count_5min")
    assert got == [("a", 1), ("b", 2), ("c", 2)]


def test_minute_rates_stream_matches_batch(spark, scratch):
    from txrisk.operators.monitor import minute_rates

    batch = score_transactions(transactions(Tables(spark, SMALL)), ScoringParams.fixture())
    path = os.path.join(scratch, "scored")
    batch.select("transaction_id", "ts", "risk_score").write.parquet(path)
    stream = spark.readStream.schema("transaction_id string, ts timestamp_ntz, risk_score double").parquet(path)
    rates = event_time.minute_rates_stream(stream, 0.8, "1 minute")
    name = "t4_" + os.path.basename(scratch).replace("-", "_")
    q = (rates.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table(name)
    want = minute_rates(batch, 0.8)
    # the newest minute stays open until a later event closes it
    last = want.agg(F.max("minute")).first()[0]
    assert rows(got, "minute", "tx", "flagged") == rows(want.filter(F.col("minute") < F.lit(last)), "minute", "tx", "flagged")


def test_dedupe_stream(spark, scratch):
    src = os.path.join(scratch, "in")
    t0 = dt.datetime(2026, 2, 8)
    write_lines(src, "a.json", [_msg("a", "C1", t0), _msg("a", "C1", t0), _msg("b", "C1", t0)])
    write_lines(src, "b.json", [_msg("a", "C1", t0), _msg("c", "C2", t0 + dt.timedelta(minutes=1))])
    from txrisk.sources.messages import decode

    dec = decode(read_transactions(spark, fmt="text", path=src, max_per_trigger=1)).select(
        "transaction_id", "customer_id", "ts")
    out = event_time.dedupe_stream(dec, "10 minutes")
    name = "t5_" + os.path.basename(scratch).replace("-", "_")
    q = (out.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert rows(spark.table(name), "transaction_id") == [("a",), ("b",), ("c",)]


def _batch(spark, *msgs):
    return spark.createDataFrame([(m,) for m in msgs], "value string")


def _sinks(scratch):
    return SinkPaths(os.path.join(scratch, "e"), os.path.join(scratch, "a"), os.path.join(scratch, "q"))


def test_duplicates_in_a_batch_count_once(spark, scratch):
    sinks = _sinks(scratch)
    m = _msg("a", "C1", dt.datetime(2026, 2, 8))
    ScoringJob(sinks).process(_batch(spark, m, m, m), 0)
    assert rows(table(spark, sinks.enriched), "transaction_id", "tx_count_5min") == [("a", 1)]


def test_same_id_under_two_times_is_stored_once(spark, scratch):
    sinks = _sinks(scratch)
    t0 = dt.datetime(2026, 2, 8)
    job = ScoringJob(sinks)
    job.process(_batch(spark, _msg("a", "C1", t0)), 0)
    job.process(_batch(spark, _msg("a", "C1", t0 + dt.timedelta(days=2)), _msg("b", "C1", t0 + dt.timedelta(days=2))), 1)
    got = spark.read.parquet(sinks.enriched)
    assert rows(got, "transaction_id", "ts") == [("a", t0), ("b", t0 + dt.timedelta(days=2))]


def test_late_row_raises_stored_counts_and_alerts_follow(spark, scratch):
    """``a`` comes first; then ``b``, older by a minute, with a repeated ``a``."""
    sinks = _sinks(scratch)
    p = ScoringParams(alert_threshold=0.78, coef_tx_count=1.0, intercept=0.2, coef_amount=0.0)
    t0 = dt.datetime(2026, 2, 8, 12)
    a, b = _msg("a", "C1", t0), _msg("b", "C1", t0 - dt.timedelta(minutes=1))
    job = ScoringJob(sinks, params=p)
    job.process(_batch(spark, a), 0)
    assert rows(table(spark, sinks.enriched), "transaction_id", "tx_count_5min") == [("a", 1)]
    before = rows(table(spark, sinks.alerts), "transaction_id") if os.path.isdir(sinks.alerts + "/event_date=2026-02-08") else []
    assert before == []
    for _ in range(2):  # the second time is a replay
        job.process(_batch(spark, b, a), 1)
        got = table(spark, sinks.enriched)
        assert rows(got, "transaction_id", "tx_count_5min") == [("a", 2), ("b", 1)]
        alerts = table(spark, sinks.alerts)
        assert rows(alerts, "transaction_id", "risk_score") == rows(got.filter("risk_score >= 0.78"), "transaction_id", "risk_score")
        assert rows(alerts, "transaction_id") == [("a",)]


def test_unreadable_table_is_an_error_not_an_empty_one(spark, scratch):
    from txrisk.sinks.keyed import read_table

    assert read_table(spark, os.path.join(scratch, "none")) is None
    os.makedirs(os.path.join(scratch, "empty"))
    assert read_table(spark, os.path.join(scratch, "empty")) is None
    write_lines(os.path.join(scratch, "bad"), "x.parquet", ["no parquet"])
    with pytest.raises(Exception):
        read_table(spark, os.path.join(scratch, "bad"))


def test_key_check_reads_only_the_batch_buckets(spark, scratch):
    from txrisk.sinks.keyed import taken_keys, write_keys

    path = os.path.join(scratch, "t")
    ids = spark.range(1000).selectExpr("cast(id as string) as transaction_id")
    write_keys(ids, path, 0)
    one = ids.filter("transaction_id = '17'")
    got = taken_keys(one, path, 1)
    assert ("17",) in rows(got) and got.count() < 50
    assert taken_keys(one, path, 0).count() == 0  # an earlier attempt of the same batch
    assert "PartitionFilters: [" in got._jdf.queryExecution().toString()


def test_quarantine_table_replaces_a_replayed_batch(spark, scratch):
    sinks = SinkPaths(os.path.join(scratch, "e"), os.path.join(scratch, "a"), os.path.join(scratch, "q"))
    job = ScoringJob(sinks, params=ScoringParams.fixture())
    good = _msg("g1", "C1", dt.datetime(2026, 2, 8))
    batch = spark.createDataFrame([(good,), ("garbage",), ('{"transaction_id":"x"}',)], "value string")
    job.process(batch, 7)
    job.process(batch, 7)  # replay of the same batch id
    q = spark.read.parquet(sinks.quarantine)
    assert rows(q, "batch_id", "reason") == [(7, "malformed_json"), (7, "missing_field")]
    job.process(spark.createDataFrame([("more garbage",)], "value string"), 8)
    assert spark.read.parquet(sinks.quarantine).count() == 3
    assert rows(table(spark, sinks.enriched), "transaction_id") == [("g1",)]


def test_event_time_trailing_count_across_buckets(spark, scratch):
    """Stream counts equal the batch window when rows straddle bucket edges."""
    import random

    from txrisk.operators.features import trailing_count

    rnd = random.Random(7)
    t0 = dt.datetime(2026, 2, 8)
    events = [(f"t{i}", rnd.choice(["C1", "C2"]), t0 + dt.timedelta(seconds=rnd.randint(0, 3600))) for i in range(60)]
    events.sort(key=lambda e: e[2])
    src = os.path.join(scratch, "in")
    for n in range(3):
        write_lines(src, f"{n}.json", [_msg(*e) for e in events[n * 20:(n + 1) * 20]])
    write_lines(src, "z.json", [_msg("z", "C9", t0 + dt.timedelta(days=1))])
    from txrisk.sources.messages import decode

    dec = decode(read_transactions(spark, fmt="text", path=src, max_per_trigger=1)).select(
        "transaction_id", "customer_id", "ts")
    counts = event_time.trailing_count_stream(dec, 300, "10 minutes")
    name = "t3b_" + os.path.basename(scratch).replace("-", "_")
    q = (counts.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = rows(spark.table(name).filter("customer_id != 'C9'"), "transaction_id", "tx_count_5min")
    batch = spark.createDataFrame(events, "transaction_id string, customer_id string, ts timestamp_ntz")
    want = rows(trailing_count(batch, 300 * 10**6, 2), "transaction_id", "tx_count_5min")
    assert got == want


def test_out_of_order_arrival_ends_in_batch_counts(spark, scratch):
    """Files arrive newest first; no row is dropped as late, and the counts and
    scores end up as the batch query's."""
    tx = transactions(Tables(spark, SMALL)).orderBy("ts", "transaction_id")
    msgs = [r.value for r in to_messages(tx).collect()]
    src = os.path.join(scratch, "in")
    step = (len(msgs) + 2) // 3
    for i in (2, 1, 0):  # newest file first
        write_lines(src, f"part-{i}.json", msgs[i * step:(i + 1) * step])
    write_lines(src, "bad.json", ["not json"])
    sinks = _sinks(scratch)
    raw = read_transactions(spark, fmt="text", path=src, max_per_trigger=1)
    run_available(raw, ScoringJob(sinks, params=ScoringParams.fixture()), os.path.join(scratch, "ckpt"))
    got = table(spark, sinks.enriched)
    batch = score_transactions(tx, ScoringParams.fixture())
    assert rows(got, "transaction_id", "tx_count_5min", "risk_score") == rows(batch, "transaction_id", "tx_count_5min", "risk_score")
    alerts = rows(table(spark, sinks.alerts), "transaction_id", "risk_score")
    assert alerts == rows(got.filter("risk_score >= 0.8"), "transaction_id", "risk_score")
    assert rows(spark.read.parquet(sinks.quarantine), "reason") == [("malformed_json",)]


def test_quarantine_stream_keeps_rejected_messages(spark, scratch):
    from txrisk.streaming.job import start_quarantine

    src = os.path.join(scratch, "in")
    bad_amount = json.dumps({"transaction_id": "n", "customer_id": "C1", "ts": "2026-02-08T00:00:00+00:00", "amount": float("nan")})
    write_lines(src, "a.json", ["not json", bad_amount, _msg("g", "C1", dt.datetime(2026, 2, 8))])
    q = start_quarantine(read_transactions(spark, fmt="text", path=src), os.path.join(scratch, "q"),
                         os.path.join(scratch, "qckpt"), trigger={"availableNow": True})
    q.awaitTermination(300)
    assert rows(spark.read.parquet(os.path.join(scratch, "q")), "reason") == [("bad_amount",), ("malformed_json",)]


def _alerts_follow(spark, sinks, p):
    """The current alerts are those built from the current enriched rows."""
    from txrisk.operators.alerts import build_alerts

    want = build_alerts(table(spark, sinks.enriched), p)
    cols = ("transaction_id", "ts", "risk_score", "reason", "severity")
    assert rows(table(spark, sinks.alerts), *cols) == rows(want, *cols)
    return rows(want, "transaction_id")


def test_revision_under_the_threshold_takes_its_alert_back(spark, scratch):
    """A negative count weight: ``b`` alone is flagged; with the earlier ``a`` it isn't."""
    sinks = _sinks(scratch)
    p = ScoringParams(alert_threshold=0.8, intercept=4.0, coef_tx_count=-2.0, coef_amount=0.0)
    t0 = dt.datetime(2026, 2, 8, 12)
    job = ScoringJob(sinks, params=p)
    job.process(_batch(spark, _msg("b", "C1", t0)), 0)
    assert _alerts_follow(spark, sinks, p) == [("b",)]
    for _ in range(2):  # the second time is a replay
        job.process(_batch(spark, _msg("a", "C1", t0 - dt.timedelta(minutes=1))), 1)
        assert _alerts_follow(spark, sinks, p) == [("a",)]
    # nothing more to take back when it falls further
    job.process(_batch(spark, _msg("c", "C1", t0 - dt.timedelta(minutes=2))), 2)
    assert _alerts_follow(spark, sinks, p) == [("c",)]


@pytest.mark.parametrize("weight", [-0.9, 0.9])
def test_alerts_follow_in_any_order(spark, scratch, weight):
    import random

    rnd = random.Random(11)
    t0 = dt.datetime(2026, 2, 8, 23, 50)
    events = [_msg(f"t{i}", rnd.choice(["C1", "C2"]), t0 + dt.timedelta(seconds=rnd.randint(0, 1800))) for i in range(60)]
    p = ScoringParams(intercept=2.6 if weight < 0 else -2.0, coef_tx_count=weight, coef_amount=0.0)
    rnd.shuffle(events)
    sinks = _sinks(scratch)
    job = ScoringJob(sinks, params=p)
    for i in range(3):
        job.process(_batch(spark, *events[i * 20:(i + 1) * 20]), i)
        assert _alerts_follow(spark, sinks, p)
    from txrisk.sources.messages import decode

    batch = score_transactions(decode(_batch(spark, *events)).drop("value", "ts_text", "_corrupt_record"), p)
    assert rows(table(spark, sinks.enriched), "transaction_id", "tx_count_5min", "risk_score") == rows(batch, "transaction_id", "tx_count_5min", "risk_score")
    changes = spark.read.parquet(sinks.alerts)
    assert weight > 0 or changes.filter("retracted").count() > 0


class FittedLike:
    """A fitted pipeline whose count weight is negative."""

    def transform(self, df):
        from pyspark.ml.functions import array_to_vector

        p = F.lit(1.0) / (F.lit(1.0) + F.exp(F.col("tx_count_5min") * 2.0 - 4.0))
        return df.withColumn("probability", array_to_vector(F.array(1 - p, p)))


def test_alerts_follow_a_fitted_model(spark, scratch):
    sinks = _sinks(scratch)
    p = ScoringParams()
    t0 = dt.datetime(2026, 2, 8, 12)
    job = ScoringJob(sinks, params=p, model=FittedLike())
    job.process(_batch(spark, _msg("b", "C1", t0)), 0)
    assert _alerts_follow(spark, sinks, p) == [("b",)]
    job.process(_batch(spark, _msg("a", "C1", t0 - dt.timedelta(minutes=1))), 1)
    assert _alerts_follow(spark, sinks, p) == [("a",)]


def _scanned(df):
    """(partitions, rows) that the scans of an executed frame read."""
    leaves, parts, out = [df._jdf.queryExecution().executedPlan()], 0, 0
    while leaves:
        node = leaves.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            leaves.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            leaves.append(node.plan())
            continue
        if name.startswith("Scan parquet"):
            metrics = node.metrics()
            out += metrics.apply("numOutputRows").value()
            parts += metrics.apply("numPartitions").value() if metrics.contains("numPartitions") else 0
        children = node.children()
        leaves += [children.apply(i) for i in range(children.size())]
    return parts, out


def test_one_late_row_reads_two_dates(spark, scratch):
    sinks = _sinks(scratch)
    job = ScoringJob(sinks)
    t0 = dt.datetime(2026, 2, 8, 12)
    for day in range(3):  # one batch a day
        job.process(_batch(spark, *[_msg(f"d{day}-{i}", f"C{i}", t0 + dt.timedelta(days=day)) for i in range(8)]), day)
    late = _batch(spark, _msg("late", "C1", t0 - dt.timedelta(seconds=60)), _msg("now", "C1", t0 + dt.timedelta(days=3)))
    from txrisk.sources.messages import decode

    stored = job._stored_around(decode(late).drop("value", "ts_text", "_corrupt_record"), 99)
    assert rows(stored, "transaction_id") == [("d0-1",)]
    plan = stored._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.lower()
    parts, read = _scanned_after_collect(stored)
    assert parts <= 2 and read <= 8


def _scanned_after_collect(df):
    df.collect()
    return _scanned(df)


def test_a_batch_reads_no_more_as_the_table_ages(spark, scratch):
    """Scan metrics of the stored rows read for batches 1 and 6, of 20 rows a day: the same."""
    sinks = _sinks(scratch)
    job = ScoringJob(sinks)
    t0 = dt.datetime(2026, 2, 8, 12)
    from txrisk.sources.messages import decode

    read = {}
    for n in range(7):
        df = _batch(spark, *[_msg(f"{n}-{i}", f"C{i % 5}", t0 + dt.timedelta(days=n // 2, seconds=60 * n + i)) for i in range(20)])
        if n % 5 == 1:
            read[n] = _scanned_after_collect(job._stored_around(decode(df).drop("value", "ts_text", "_corrupt_record"), n))[1]
        # the stream's own path: which keys are new is for its state to say
        tagged = decode(df).withColumn("reason", F.lit(None).cast("string")).withColumn("fresh", F.lit(False))
        fresh = tagged.select("transaction_id").withColumn("fresh", F.lit(True))
        job.process_tagged(tagged.unionByName(fresh, allowMissingColumns=True), n)
    assert read[1] == 20 and read[6] == 0
    assert spark.read.parquet(sinks.enriched).count() == 140
    assert not os.path.exists(sinks.enriched + ".keys")


def test_stream_state_knows_keys_of_earlier_batches(spark, scratch):
    """Repeated and changed copies in later files, across a restart, are stored once."""
    src = os.path.join(scratch, "in")
    t0 = dt.datetime(2026, 2, 8)
    write_lines(src, "a.json", [_msg("a", "C1", t0), _msg("b", "C1", t0), _msg("b", "C1", t0 + dt.timedelta(days=1))])
    sinks = _sinks(scratch)
    ckpt = os.path.join(scratch, "ckpt")
    run_available(read_transactions(spark, fmt="text", path=src, max_per_trigger=1), ScoringJob(sinks), ckpt)
    write_lines(src, "b.json", [_msg("a", "C1", t0 + dt.timedelta(days=3)), _msg("c", "C1", t0)])
    write_lines(src, "c.json", [_msg("b", "C2", t0)])
    run_available(read_transactions(spark, fmt="text", path=src, max_per_trigger=1), ScoringJob(sinks), ckpt)
    assert rows(spark.read.parquet(sinks.enriched).filter("batch_id >= 0").select("transaction_id").distinct()) == [("a",), ("b",), ("c",)]
    assert rows(table(spark, sinks.enriched), "transaction_id", "ts") == [("a", t0), ("b", t0), ("c", t0)]


def test_a_hot_customers_state_is_linear(spark, scratch):
    """6,000 events of one customer within a window: a few groups of state, counts as in the batch."""
    import random

    from txrisk.operators.features import trailing_count
    from txrisk.sources.messages import decode

    rnd = random.Random(3)
    t0 = dt.datetime(2026, 2, 8)
    events = [(f"t{i}", "C1", t0 + dt.timedelta(microseconds=rnd.randint(0, 290_000_000))) for i in range(6000)]
    src = os.path.join(scratch, "in")
    for n in range(2):
        write_lines(src, f"{n}.json", [_msg(*e) for e in events[n::2]])
    write_lines(src, "z.json", [_msg("z", "C9", t0 + dt.timedelta(days=1))])
    dec = decode(read_transactions(spark, fmt="text", path=src, max_per_trigger=1)).select("transaction_id", "customer_id", "ts", "amount", "category")
    counts = event_time.trailing_count_stream(dec, 300, "10 minutes", carry=("amount", "category"))
    name = "t3c_" + os.path.basename(scratch).replace("-", "_")
    q = (counts.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    for progress in q.recentProgress:
        counted, deduped = sorted(progress.stateOperators, key=lambda o: o.numRowsTotal)
        assert counted.numRowsTotal <= 4 and deduped.numRowsTotal <= 6001
    got = spark.table(name).filter("customer_id = 'C1'")
    assert got.filter("amount <> 10.0 or category is not null").count() == 0
    batch = spark.createDataFrame(events, "transaction_id string, customer_id string, ts timestamp_ntz")
    want = trailing_count(batch, 300 * 10**6)
    assert rows(got.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "transaction_id", "ts", "tx_count_5min") == rows(want, "transaction_id", "ts", "tx_count_5min")


def test_late_rows_change_their_minute(spark, scratch):
    """Update mode into a keyed table: files newest first, equal to the batch rates."""
    from txrisk.operators.monitor import minute_rates
    from txrisk.sinks.keyed import current, read_table

    batch = score_transactions(transactions(Tables(spark, SMALL)), ScoringParams.fixture()).select("transaction_id", "ts", "risk_score")
    src, path = os.path.join(scratch, "scored"), os.path.join(scratch, "minutes")
    half = F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == 0
    os.makedirs(src)
    scored = spark.readStream.schema("transaction_id string, ts timestamp_ntz, risk_score double").parquet(src)
    for part in (batch.filter(half & (F.col("ts") > "2024-01-15")), batch.filter(~(half & (F.col("ts") > "2024-01-15")))):
        part.coalesce(1).write.mode("append").parquet(src)
        q = event_time.start_minute_rates(scored, path, 0.8, os.path.join(scratch, "ckpt"), trigger={"availableNow": True})
        q.awaitTermination(300)
    got = current(read_table(spark, path), key="minute")
    assert rows(got, "minute", "tx", "flagged") == rows(minute_rates(batch, 0.8), "minute", "tx", "flagged")


def test_zscores_are_those_of_the_rows_own_batch(spark, scratch):
    sinks = _sinks(scratch)
    t0 = dt.datetime(2026, 2, 8, 12)

    def msg(tid, amount, minutes):
        return json.dumps({"transaction_id": tid, "customer_id": "C1", "ts": (t0 + dt.timedelta(minutes=minutes)).isoformat() + "+00:00", "amount": amount})

    job = ScoringJob(sinks)
    job.process(_batch(spark, msg("a", 1.0, 0), msg("b", 2.0, 60), msg("c", 3.0, 120)), 0)
    job.process(_batch(spark, msg("d", 10.0, -1), msg("e", 30.0, 300)), 1)  # raises a's count
    got = {r.transaction_id: (r.tx_count_5min, round(r.amount_zscore, 6)) for r in table(spark, sinks.enriched).collect()}
    assert got == {"a": (2, -1.0), "b": (1, 0.0), "c": (1, 1.0), "d": (1, -0.707107), "e": (1, 0.707107)}


def test_a_batch_writes_about_a_file_to_each_partition(spark, scratch):
    """In the session of a stream, which plans without AQE for its state's sake."""
    from collections import Counter

    src = os.path.join(scratch, "in")
    t0 = dt.datetime(2026, 2, 8)
    events = [_msg(f"t{i}", f"C{i % 40}", t0 + dt.timedelta(hours=i % 96, seconds=i)) for i in range(800)]
    write_lines(src, "part-000.json", events)
    sinks = _sinks(scratch)
    raw = read_transactions(spark, fmt="text", path=src)
    seen = []

    class Watched(ScoringJob):
        def process_tagged(self, batch_df, batch_id):
            get = lambda: batch_df.sparkSession.conf.get("spark.sql.adaptive.enabled")
            seen.append(get())
            super().process_tagged(batch_df, batch_id)
            seen.append(get())

    run_available(raw, Watched(sinks), os.path.join(scratch, "ckpt"))
    files = Counter(folder for folder, _, names in os.walk(sinks.enriched) for n in names if n.endswith(".parquet"))
    assert len(files) == 4 * 4 and max(files.values()) <= 2  # dates by buckets of customers
    assert spark.read.parquet(sinks.enriched).count() == 800
    assert seen == ["false", "false"]  # the stream's own plans keep their setting


def test_message_files_grow_with_the_cores(spark, scratch):
    from txrisk.plans import streamed

    tx = transactions(Tables(spark, SMALL))
    path = os.path.join(scratch, "messages")
    streamed.message_files(tx, path)
    parts = [n for n in os.listdir(path) if n.endswith(".txt")]
    assert len(parts) == streamed.BATCHES * streamed.files_a_batch(spark) >= 2 * spark.sparkContext.defaultParallelism
    assert spark.read.text(path).select(F.trim("value")).distinct().count() == tx.count()


def test_streams_keys_are_off_the_heap_whatever_the_session(spark, monkeypatch):
    """Spark's default state store is a map of all keys on the executors' heap; stores
    that stay open cost memory too, as many as there are partitions."""
    from txrisk.plans import streamed
    from txrisk.session import STATE_CONF

    conf = [*STATE_CONF, *streamed.STORES]
    old = {k: spark.conf.get(k, None) for k in conf}
    stores = spark._jvm.org.apache.spark.sql.execution.streaming.state.RocksDBMemoryManager.getNumRocksDBInstances
    queries = []
    monkeypatch.setattr(streamed, "start_scoring", lambda *a, **k: queries.append(start_scoring(*a, **k)) or queries[-1])
    try:
        for k in conf:
            spark.conf.unset(k)
        opened = stores(True)
        tx = transactions(Tables(spark, SMALL))
        sinks = streamed.streamed(tx, ScoringParams.fixture())
        assert [spark.conf.get(k, None) for k in conf] == [None] * len(conf)
    finally:
        for k, v in old.items():
            if v is not None:
                spark.conf.set(k, v)
    states = [s for q in queries for b in q.recentProgress for s in b["stateOperators"]]
    assert len(queries) == 2 and states
    assert all(any(m.startswith("rocksdb") for m in s["customMetrics"]) for s in states)
    assert stores(True) <= opened
    assert table(spark, sinks.enriched).select("transaction_id").distinct().count() == tx.count()
