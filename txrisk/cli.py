"""Command line: train a model, run the scoring stream, report on the tables.

    python -m txrisk.cli train  --tables DIR --model PATH
    python -m txrisk.cli stream --format kafka --bootstrap HOST:PORT --topic transactions \\
                                --enriched PATH --alerts PATH [--quarantine PATH] [--model PATH]
    python -m txrisk.cli report --enriched PATH [--alerts PATH] --out DIR [--since D --until D]

``report`` prints the bounded tables (KPIs, SLA verdict, cost model, sweep,
best threshold, hotspots, newest rows) as JSON lines and writes the
per-customer and per-minute tables, which grow with the data, as parquet
under ``--out``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession


def _session(args) -> SparkSession:
    from txrisk.session import build_session

    extra = {"spark.ui.showConsoleProgress": "false"}
    return build_session(
        args.master, app_name=f"txrisk-{args.cmd}", extra_conf=extra, input_bytes=int(args.input_gb * 1e9), total_cores=args.cores
    )


def _emit(name: str, df: DataFrame) -> None:
    """Print a bounded result (at most a few dozen rows) as JSON lines."""
    for row in df.collect():
        print(json.dumps({"table": name, **row.asDict()}, default=str))


def cmd_train(args) -> None:
    from txrisk.operators import model as ml
    from txrisk.operators.scoring import score_transactions
    from txrisk.params import ModelParams, ScoringParams
    from txrisk.session import materialize
    from txrisk.sources.tables import Tables
    from txrisk.sources.transactions import transactions

    spark = _session(args)
    p = ScoringParams.fixture() if args.fixture_params else ScoringParams()
    mp = ModelParams()
    data = ml.with_label(score_transactions(transactions(Tables(spark, args.tables)), p), p)
    data = materialize(data.drop("risk_score").select(*ml.TRAINING_COLUMNS))
    train, test = ml.hash_split(data, mp.train_fraction, mp.split_seed)
    model = ml.fit(train, mp, checkpoint=False)
    ml.save(model, args.model)
    pred = ml.score_model(model, test)
    _emit("evaluation", ml.evaluate(pred))
    print(json.dumps({"table": "auc", "auc": ml.auc(pred)}))
    coefs = ml.coefficients(model, mp)
    print(json.dumps({"table": "coefficients", **coefs}))


def cmd_stream(args) -> None:
    from txrisk.operators import model as ml
    from txrisk.params import ScoringParams
    from txrisk.session import streaming_checkpoint
    from txrisk.streaming.job import ScoringJob, SinkPaths, start_scoring
    from txrisk.streaming.source import read_transactions

    spark = _session(args)
    options = {}
    if args.format == "kafka":
        options = {"kafka.bootstrap.servers": args.bootstrap, "subscribe": args.topic}
    raw = read_transactions(spark, fmt=args.format, options=options, path=args.path)
    job = ScoringJob(
        SinkPaths(args.enriched, args.alerts, args.quarantine, args.minutes),
        params=ScoringParams.fixture() if args.fixture_params else ScoringParams(),
        count_mode=args.count_mode,
        model=ml.load(args.model) if args.model else None,
    )
    ckpt = args.checkpoint or streaming_checkpoint(spark, "scoring")
    trigger = {"availableNow": True} if args.once else {"processingTime": f"{args.trigger_seconds} seconds"}
    start_scoring(raw, job, ckpt, trigger=trigger).awaitTermination()


def date_range(table: DataFrame, since: str | None, until: str | None) -> DataFrame:
    """Rows whose event date lies in [since, until]; a filter on the
    partition column, so only those date folders are listed and read."""
    from pyspark.sql import functions as F

    from txrisk.sinks.keyed import PARTITION_COLUMN

    if since:
        table = table.filter(F.col(PARTITION_COLUMN) >= F.lit(since).cast("date"))
    if until:
        table = table.filter(F.col(PARTITION_COLUMN) <= F.lit(until).cast("date"))
    return table


def cmd_report(args) -> None:
    from txrisk.operators import economics, investigate, monitor
    from txrisk.operators.alerts import alert_detail, recent
    from txrisk.params import CostParams, MonitorParams, SweepParams, ViewFilter
    from txrisk.schema import ALERT_SCHEMA, ALERT_TABLE_SCHEMA, ENRICHED_SCHEMA
    from txrisk.session import materialize
    from txrisk.sinks.keyed import current, read_table
    from txrisk.streaming.job import minute_totals

    spark = _session(args)
    m = MonitorParams(threshold=args.threshold, sla_window_minutes=args.sla_window, sla_limit_pct=args.sla_limit)
    c = CostParams(args.loss, args.review_cost, args.fp_cost, args.efficiency)
    vf = ViewFilter(tuple(args.country or ()), tuple(args.merchant or ()), tuple(args.category or ()))
    table = current(date_range(read_table(spark, args.enriched, ENRICHED_SCHEMA), args.since, args.until))
    view = monitor.view_filter(table, vf)
    if args.customer:
        # the drill-down reads the unfiltered table
        own = investigate.for_customer(table, args.customer)
        _emit("customer_summary", investigate.customer_summary(own, m.threshold))
        _emit("customer_action", investigate.customer_actions(own, m.threshold, m.block_score))
        for col in ("country", "merchant"):
            _emit(f"customer_top_{col}", investigate.customer_top(own, col, m.top_k_profile))
        _emit("customer_timeline", investigate.customer_timeline(own, m.timeline_rows))
        investigate.customer_series(table, args.customer).write.mode("overwrite").parquet(os.path.join(args.out, "customer_series"))
        return

    _emit("kpi_summary", monitor.kpi_summary(view, m))
    rates = monitor.minute_rates(view, m.threshold)
    rolling = monitor.sla_rolling(rates, m.sla_window_minutes)
    _emit("sla_verdict", monitor.sla_verdict(rolling, m.sla_limit_pct))
    _emit("cost_model", economics.cost_model(view, m.threshold, c))
    # at most 50 rows; the best threshold follows from them without another pass
    sweep = materialize(economics.threshold_sweep(view, SweepParams(), c))
    _emit("threshold_sweep", sweep)
    _emit("best_threshold", economics.best_threshold(sweep))
    flagged = monitor.flagged(view, m.threshold)
    _emit("hotspot_country", monitor.hotspots(flagged, "country", m.top_k_hotspots))
    _emit("hotspot_merchant", monitor.hotspots(flagged, "merchant", m.top_k_hotspots))
    _emit("latest_transactions", recent(view, m.recent_rows, monitor.VIEW_COLUMNS))
    if args.minutes:
        changes = read_table(spark, args.minutes)
        if changes is not None:
            minute_totals(date_range(changes, args.since, args.until)).write.mode("overwrite").parquet(os.path.join(args.out, "minute_rates"))
    if args.alerts:
        alerts = read_table(spark, args.alerts, ALERT_TABLE_SCHEMA)
        if alerts is not None:
            alerts = current(date_range(alerts, args.since, args.until)).select(*[f.name for f in ALERT_SCHEMA.fields])
            _emit("recent_alerts", recent(alert_detail(alerts, table), m.recent_rows))

    out = args.out
    monitor.filter_options(table).write.mode("overwrite").parquet(os.path.join(out, "filter_options"))
    for col, bins in (("amount", m.amount_bins), ("risk_score", m.score_bins)):
        _emit(f"{col}_histogram", monitor.histogram(view, col, bins))
    rolling.write.mode("overwrite").parquet(os.path.join(out, "sla_rolling"))
    investigate.customer_summary(table, m.threshold).write.mode("overwrite").parquet(os.path.join(out, "customer_summary"))
    investigate.customer_actions(table, m.threshold, m.block_score).write.mode("overwrite").parquet(
        os.path.join(out, "customer_actions"))
    investigate.customer_timeline(table, m.timeline_rows).write.mode("overwrite").parquet(
        os.path.join(out, "customer_timeline"))
    for col in ("country", "merchant"):
        investigate.customer_top(table, col, m.top_k_profile).write.mode("overwrite").parquet(
            os.path.join(out, f"customer_top_{col}"))


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="txrisk")
    ap.add_argument("--master", default=None, help="Spark master (default: the launcher's)")
    ap.add_argument("--input-gb", type=float, default=0, help="size of the input; with --cores, sizes the partitions")
    ap.add_argument("--cores", type=int, default=0, help="cores of the cluster")
    sub = ap.add_subparsers(dest="cmd", required=True)

    t = sub.add_parser("train", help="fit, evaluate and save the scoring pipeline")
    t.add_argument("--tables", required=True, help="folder holding events/customer/nation parquet tables")
    t.add_argument("--model", required=True, help="where to save the fitted pipeline")
    t.add_argument("--fixture-params", action="store_true", help="cut-offs that fit the test tables (see FIXTURES.md)")

    s = sub.add_parser("stream", help="score a message stream into the keyed tables")
    s.add_argument("--format", default="kafka", choices=["kafka", "text"])
    s.add_argument("--bootstrap", help="broker list (kafka)")
    s.add_argument("--topic", default="transactions")
    s.add_argument("--path", help="folder of JSON-lines files (text)")
    s.add_argument("--enriched", required=True)
    s.add_argument("--alerts", required=True)
    s.add_argument("--quarantine")
    s.add_argument("--minutes", help="per-minute counts, kept up to date as rows come late or are scored anew")
    s.add_argument("--checkpoint", help="default: <spark.checkpoint.dir>/streams/scoring")
    s.add_argument("--model", help="fitted pipeline; default: the linear score")
    s.add_argument("--count-mode", default="trailing", choices=["trailing", "batch"])
    s.add_argument("--trigger-seconds", type=int, default=5)
    s.add_argument("--once", action="store_true", help="process what is available, then stop")
    s.add_argument("--fixture-params", action="store_true")

    r = sub.add_parser("report", help="dashboard numbers from the enriched / alert tables")
    r.add_argument("--enriched", required=True)
    r.add_argument("--alerts")
    r.add_argument("--minutes", help="the stream's per-minute counts, written on as minute_rates")
    r.add_argument("--out", required=True, help="folder for the per-customer and per-minute tables")
    r.add_argument("--since", help="first event date (YYYY-MM-DD); prunes date partitions")
    r.add_argument("--until", help="last event date (YYYY-MM-DD); prunes date partitions")
    r.add_argument("--threshold", type=float, default=0.80)
    r.add_argument("--sla-window", type=int, default=5)
    r.add_argument("--sla-limit", type=float, default=8.0)
    r.add_argument("--loss", type=float, default=250.0)
    r.add_argument("--review-cost", type=float, default=2.0)
    r.add_argument("--fp-cost", type=float, default=5.0)
    r.add_argument("--efficiency", type=float, default=0.80)
    r.add_argument("--customer", help="drill down into one customer instead of the overview")
    r.add_argument("--country", nargs="*")
    r.add_argument("--merchant", nargs="*")
    r.add_argument("--category", nargs="*")
    return ap


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    {"train": cmd_train, "stream": cmd_stream, "report": cmd_report}[args.cmd](args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
