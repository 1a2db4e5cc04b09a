"""The command line end to end: stream a folder, then report on the tables."""

from __future__ import annotations

import json
import os

from tests.conftest import SMALL
from tests.test_streaming import message_files, table
from txrisk import cli


def test_stream_then_report(spark, scratch, capsys):
    src = os.path.join(scratch, "in")
    n = message_files(spark, src, parts=2)
    enriched, alerts = os.path.join(scratch, "enriched"), os.path.join(scratch, "alerts")
    cli.main(["stream", "--format", "text", "--path", src, "--enriched", enriched, "--alerts", alerts,
              "--checkpoint", os.path.join(scratch, "ckpt"), "--once", "--fixture-params"])
    assert table(spark, enriched).count() == n
    capsys.readouterr()
    cli.main(["report", "--enriched", enriched, "--alerts", alerts, "--out", os.path.join(scratch, "out")])
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    tables = {x["table"] for x in lines}
    assert {"kpi_summary", "sla_verdict", "cost_model", "threshold_sweep", "best_threshold",
            "hotspot_country", "latest_transactions", "recent_alerts"} <= tables
    kpi = next(x for x in lines if x["table"] == "kpi_summary")
    assert kpi["n_tx"] == n
    assert sum(1 for x in lines if x["table"] == "threshold_sweep") == 50
    summary = spark.read.parquet(os.path.join(scratch, "out", "customer_summary"))
    assert summary.groupBy().sum("n_tx").first()[0] == n
    cli.main(["report", "--enriched", enriched, "--customer", "C000007", "--out", os.path.join(scratch, "out")])
    own = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert {x["customer_id"] for x in own if "customer_id" in x} == {"C000007"}
    assert {"customer_summary", "customer_action", "customer_timeline"} <= {x["table"] for x in own}


def test_defaults_are_five_minutes_and_no_alerts_is_no_error(spark, scratch, capsys):
    """Three rows of one customer, minutes apart: a 300 s window by default."""
    import datetime as dt

    from tests.test_streaming import _msg, write_lines

    t0 = dt.datetime(2026, 2, 8)
    src, enriched, alerts = (os.path.join(scratch, x) for x in ("in", "enriched", "alerts"))
    write_lines(src, "a.json", [_msg(i, "C1", t0 + dt.timedelta(minutes=m)) for i, m in (("a", 0), ("b", 4), ("c", 10))])
    cli.main(["stream", "--format", "text", "--path", src, "--enriched", enriched, "--alerts", alerts,
              "--checkpoint", os.path.join(scratch, "ckpt"), "--once"])
    got = sorted((r.transaction_id, r.tx_count_5min) for r in table(spark, enriched).collect())
    assert got == [("a", 1), ("b", 2), ("c", 1)]
    cli.main(["report", "--enriched", enriched, "--alerts", alerts, "--out", os.path.join(scratch, "out")])
    assert '"kpi_summary"' in capsys.readouterr().out


def test_train_saves_a_loadable_model(spark, scratch, capsys):
    from txrisk.operators import model as ml

    path = os.path.join(scratch, "model")
    cli.main(["train", "--tables", SMALL, "--model", path])
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert {"evaluation", "auc", "coefficients"} <= {x["table"] for x in out}
    assert len(ml.load(path).stages) == 4


def test_report_date_range_prunes_partitions(spark, scratch):
    import contextlib
    import io

    src = os.path.join(scratch, "in")
    message_files(spark, src, parts=1)
    enriched = os.path.join(scratch, "enriched")
    cli.main(["stream", "--format", "text", "--path", src, "--enriched", enriched,
              "--alerts", os.path.join(scratch, "alerts"), "--checkpoint", os.path.join(scratch, "ckpt"), "--once"])
    part = cli.date_range(spark.read.parquet(enriched), "2024-01-10", "2024-01-12")
    days = {r[0].isoformat() for r in part.select("event_date").distinct().collect()}
    assert days == {"2024-01-10", "2024-01-11", "2024-01-12"}
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        part.explain()
    assert "PartitionFilters: [isnotnull(event_date" in buf.getvalue()
