"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Every query reads the driver's tables (through the ``transactions`` view
or the wide fixture) and runs over all of their rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions.columns import round_to, rule_label
from txrisk.operators import economics, investigate, monitor
from txrisk.operators.alerts import alert_detail, build_alerts, latest_scored, recent
from txrisk.operators.contracts import key_violations
from txrisk.operators.features import amount_zscore, base_features, batch_customer_count, group_zscore
from txrisk.operators.scoring import SCORE_COLUMN, enriched, score_linear, score_transactions
from txrisk.operators import model as ml
from txrisk.params import CostParams, ModelParams, MonitorParams, ScoringParams, SweepParams, ViewFilter
from txrisk.plans import oracle
from txrisk.plans.streamed import streamed
from txrisk.schema import ALERT_SCHEMA, ALERT_TABLE_SCHEMA, ENRICHED_SCHEMA
from txrisk.session import new_folder, pin_utc
from txrisk.sinks.keyed import current, new_rows, read_table
from txrisk.sources import messages
from txrisk.sources.tables import Tables
from txrisk.sources.transactions import transactions, wide_transactions
from txrisk.streaming.job import minute_totals

P = ScoringParams.fixture()
REF = ScoringParams(grain_seconds=60)
#: Scores that fall as the count rises, so that late rows take alerts back.
FALLING = replace(P, intercept=-2.0, coef_tx_count=-0.5)
M = MonitorParams()
C = CostParams()
S = SweepParams()
MP = ModelParams()
# View filter of the registered ``view_filter`` query: home and risky
# countries, two categories, every merchant.
VF = ViewFilter(
    countries=(P.home_country, *P.risky_countries),
    categories=(P.special_category, "signup"),
)

DRILLDOWN_CUSTOMER = "C000007"
#: A coefficient table for the model's scorer, the same on both sides.
COEFFICIENTS = {
    "intercept": -4.0,
    "numeric": {"amount": 0.02, "amount_log": 0.1, "tx_count_5min": 0.15, "is_foreign": 0.25, "hour": -0.01},
    "categorical": {
        "country": {"NATION_0": -0.5, "NATION_3": 0.75, "NATION_7": 0.5},
        "category": {"purchase": 0.5, "signup": -0.25},
        "merchant": {"M1": 0.125, "M4": -0.125},
    },
}

Query = Callable[[SparkSession, str], DataFrame]


def _tables(spark: SparkSession, sf_dir: str) -> Tables:
    pin_utc(spark)
    return Tables(spark, sf_dir)


def _tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(_tables(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_transactions(_tx(spark, sf_dir), P)


def q_transactions(spark, sf_dir):
    return _tx(spark, sf_dir)


def q_base_features(spark, sf_dir):
    return base_features(_tx(spark, sf_dir), P).select(
        "transaction_id", "hour", "is_foreign", round_to("amount_log", 6).alias("amount_log")
    )


def q_tx_count(spark, sf_dir):
    return _scored(spark, sf_dir).select("transaction_id", "customer_id", "ts", "tx_count_5min")


def q_score_sql(spark, sf_dir):
    return _scored(spark, sf_dir).select("transaction_id", "risk_score")


def q_alert_build(spark, sf_dir):
    return build_alerts(_scored(spark, sf_dir), P)


def q_rule_label(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.select("transaction_id", rule_label("amount", "country", "tx_count_5min", "category", P).alias("label"))


def q_enriched(spark, sf_dir):
    e = enriched(_scored(spark, sf_dir))
    return e.withColumn("amount_zscore", round_to("amount_zscore", 6))


def q_batch_customer_count(spark, sf_dir):
    return batch_customer_count(_tx(spark, sf_dir)).select("transaction_id", "customer_id", "batch_tx_count")


def q_amount_zscore(spark, sf_dir):
    z = amount_zscore(_tx(spark, sf_dir))
    return z.select("transaction_id", "amount", round_to("amount_zscore", 6).alias("amount_zscore"))


def q_customer_zscore(spark, sf_dir):
    z = group_zscore(_tx(spark, sf_dir))
    return z.select("transaction_id", "customer_id", "amount", round_to("customer_zscore", 6).alias("customer_zscore"))


def q_key_violations(spark, sf_dir):
    return key_violations(enriched(_scored(spark, sf_dir)))


def q_view_filter(spark, sf_dir):
    return monitor.view_filter(_scored(spark, sf_dir), VF).select(*monitor.VIEW_COLUMNS)


def q_flagged(spark, sf_dir):
    return monitor.flagged(_scored(spark, sf_dir), M.threshold).select(*monitor.VIEW_COLUMNS)


def q_kpi_summary(spark, sf_dir):
    return monitor.kpi_summary(_scored(spark, sf_dir), M)


def _rates(spark, sf_dir):
    return monitor.minute_rates(_scored(spark, sf_dir), M.threshold)


def q_minute_rates(spark, sf_dir):
    return _rates(spark, sf_dir).withColumn("alert_rate_pct", round_to("alert_rate_pct", 6))


def q_sla_rolling(spark, sf_dir):
    r = monitor.sla_rolling(_rates(spark, sf_dir), M.sla_window_minutes)
    return r.select(
        "minute", "tx", "flagged",
        round_to("alert_rate_pct", 6).alias("alert_rate_pct"),
        round_to("sla_rate_pct", 6).alias("sla_rate_pct"),
    )


def q_sla_verdict(spark, sf_dir):
    return monitor.sla_verdict(monitor.sla_rolling(_rates(spark, sf_dir), M.sla_window_minutes), M.sla_limit_pct)


def q_hotspot_country(spark, sf_dir):
    return monitor.hotspots(monitor.flagged(_scored(spark, sf_dir), M.threshold), "country", M.top_k_hotspots)


def q_hotspot_merchant(spark, sf_dir):
    return monitor.hotspots(monitor.flagged(_scored(spark, sf_dir), M.threshold), "merchant", M.top_k_hotspots)


def q_filter_options(spark, sf_dir):
    return monitor.filter_options(_tx(spark, sf_dir))


def q_amount_histogram(spark, sf_dir):
    return monitor.histogram(_tx(spark, sf_dir), "amount", M.amount_bins)


def q_score_histogram(spark, sf_dir):
    return monitor.histogram(_scored(spark, sf_dir), "risk_score", M.score_bins)


def q_latest_transactions(spark, sf_dir):
    newest = latest_scored(_tx(spark, sf_dir), P, M.recent_rows)
    return recent(newest, M.recent_rows, monitor.VIEW_COLUMNS)


def _alert_detail(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    return alert_detail(build_alerts(scored, P), scored)


def q_alert_detail(spark, sf_dir):
    return _alert_detail(spark, sf_dir)


def q_recent_alerts(spark, sf_dir):
    return recent(_alert_detail(spark, sf_dir), M.recent_rows)


def q_cost_model(spark, sf_dir):
    return economics.cost_model(_scored(spark, sf_dir), M.threshold, C)


def q_threshold_sweep(spark, sf_dir):
    return economics.threshold_sweep(_scored(spark, sf_dir), S, C)


def q_best_threshold(spark, sf_dir):
    return economics.best_threshold(economics.threshold_sweep(_scored(spark, sf_dir), S, C))


def q_customer_summary(spark, sf_dir):
    return investigate.customer_summary(_scored(spark, sf_dir), M.threshold)


def q_customer_top_country(spark, sf_dir):
    return investigate.customer_top(_scored(spark, sf_dir), "country", M.top_k_profile)


def q_customer_top_merchant(spark, sf_dir):
    return investigate.customer_top(_scored(spark, sf_dir), "merchant", M.top_k_profile)


def q_customer_timeline(spark, sf_dir):
    return investigate.customer_timeline(_scored(spark, sf_dir), M.timeline_rows)


def q_customer_actions(spark, sf_dir):
    return investigate.customer_actions(_scored(spark, sf_dir), M.threshold, M.block_score)


def _messages(spark, sf_dir):
    return messages.to_messages(_tx(spark, sf_dir))


def q_json_decode(spark, sf_dir):
    decoded = messages.decode(_messages(spark, sf_dir))
    accepted, _ = messages.split(decoded)
    return accepted


def q_quarantine_split(spark, sf_dir):
    """Transaction messages plus what else may come on the topic, one kind for
    each reason: the events' own ``props`` objects (no transaction fields), the
    documents' texts (no JSON), messages of every customer with a broken time
    and of every supplier with an amount that is no number, and a null message
    for every nation."""
    t = _tables(spark, sf_dir)
    foreign = t("events", "props").select(F.col("props").alias("value"))
    prose = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("text").alias("value"))
    broken = '{"transaction_id":"%s","customer_id":"C1","ts":"%s","amount":%s}'
    late = t("customer", "c_custkey").select(F.format_string(broken % ("c%d", "soon", "1.0"), "c_custkey").alias("value"))
    nan = t("supplier", "s_suppkey").select(F.format_string(broken % ("s%d", "2024-01-01T00:00:00+00:00", "NaN"), "s_suppkey").alias("value"))
    null = t("nation", "n_nationkey").select(F.lit(None).cast("string").alias("value"))
    raw = _messages(spark, sf_dir)
    for part in (foreign, prose, late, nan, null):
        raw = raw.unionByName(part)
    tagged = messages.with_reason(messages.decode(raw))
    return tagged.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n")
    )


def q_ts_parse(spark, sf_dir):
    from txrisk.functions.columns import format_ts, parse_ts

    text = _tx(spark, sf_dir).select("transaction_id", format_ts("ts").alias("ts_text"))
    return text.withColumn("ts", parse_ts("ts_text"))


def _labelled(spark, sf_dir):
    return ml.with_label(_scored(spark, sf_dir), P)


def q_score_accuracy(spark, sf_dir):
    return ml.evaluate(_labelled(spark, sf_dir))


_fits: dict[tuple, object] = {}


def _fitted(spark, sf_dir):
    """(model, training rows, held-out rows): fitted once per application and content
    of the training rows, on a written copy of the columns that the fit reads."""
    data = _labelled(spark, sf_dir).drop("risk_score").select(*ml.TRAINING_COLUMNS)
    train, test = ml.hash_split(data, MP.train_fraction, MP.split_seed)
    digest = F.sum(F.xxhash64(*train.columns).cast("decimal(38,0)"))
    key = (spark.sparkContext.applicationId, *train.agg(F.count(F.lit(1)), digest).first())
    if key not in _fits:
        _fits[key] = ml.fit(train, MP)
    return _fits[key], train, test


def q_split_counts(spark, sf_dir):
    first = ml.in_first_part(MP.train_fraction, MP.split_seed)
    return _labelled(spark, sf_dir).groupBy(F.when(first, "train").otherwise("test").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("n_positive")
    )


def q_string_index(spark, sf_dir):
    return ml.string_index(_tx(spark, sf_dir), MP)


def q_one_hot_rows(spark, sf_dir):
    return ml.one_hot_rows(_tx(spark, sf_dir), MP)


def q_value_index(spark, sf_dir):
    return ml.value_index(_tx(spark, sf_dir), MP)


def q_model_table_score(spark, sf_dir):
    """The coefficient table joined as a table, for columns of any number of values."""
    weights = spark.createDataFrame(ml.coefficient_rows(COEFFICIENTS), "feature string, value string, weight double")
    scored = ml.table_score(_labelled(spark, sf_dir).drop(SCORE_COLUMN), weights, MP)
    return scored.select("transaction_id", "label", round_to(SCORE_COLUMN, 6).alias(SCORE_COLUMN))


def _table_scored(spark, sf_dir):
    """The labelled rows, scored by a given coefficient table."""
    data = _labelled(spark, sf_dir).drop(SCORE_COLUMN)
    return data.withColumn(SCORE_COLUMN, round_to(ml.coefficient_score(COEFFICIENTS), 6))


def q_model_score(spark, sf_dir):
    return _table_scored(spark, sf_dir).select("transaction_id", "label", SCORE_COLUMN)


def q_model_evaluation(spark, sf_dir):
    """Hold-out counts and accuracy at 0.5 of the coefficient table's score."""
    _, test = ml.hash_split(_table_scored(spark, sf_dir), MP.train_fraction, MP.split_seed)
    return ml.evaluate(test)


def q_model_calibration(spark, sf_dir):
    """Mean score of the fitted model over its training rows, to 3 places."""
    model, train, _ = _fitted(spark, sf_dir)
    return ml.calibration(ml.score_model(model, train)).select("n", round_to("mean_score", 3).alias("mean_score"))


#: How far from zero the certificate's conditions may be, on the standardised scale.
FIT_TOLERANCE = 1e-4


def q_model_certificate(spark, sf_dir):
    """First-order conditions of the fitted model over its training rows."""
    model, train, _ = _fitted(spark, sf_dir)
    return ml.optimality(train, ml.coefficients(model, MP), MP, FIT_TOLERANCE)


def q_model_auc(spark, sf_dir):
    """Exact area under ROC of the coefficient table's score, over the hold-out."""
    _, test = ml.hash_split(_table_scored(spark, sf_dir), MP.train_fraction, MP.split_seed)
    return ml.exact_auc(test)


def q_model_reloaded(spark, sf_dir):
    """Rows whose score by the fitted model is another after it was saved and loaded."""
    model, train, test = _fitted(spark, sf_dir)
    path = new_folder(spark, "model")
    ml.save(model, path)
    rows = train.unionByName(test)
    again = ml.score_model(ml.load(path), rows).select("transaction_id", F.col(SCORE_COLUMN).alias("again"))
    both = ml.score_model(model, rows).select("transaction_id", SCORE_COLUMN).join(again, "transaction_id")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col(SCORE_COLUMN).eqNullSafe(F.col("again"))).alias("n_changed"))


def q_fitted_score(spark, sf_dir):
    model, train, test = _fitted(spark, sf_dir)
    return ml.score_model(model, train.unionByName(test)).select("transaction_id", "label", "risk_score")


def q_fitted_evaluation(spark, sf_dir):
    """Hold-out accuracy at 0.5 and area under ROC (MLlib evaluator)."""
    model, _, test = _fitted(spark, sf_dir)
    pred = ml.score_model(model, test)
    return ml.evaluate(pred).withColumn("auc", F.round(F.lit(ml.auc(pred)), 6))


def q_model_coefficients(spark, sf_dir):
    model, _, _ = _fitted(spark, sf_dir)
    rows = ml.coefficient_rows(ml.coefficients(model, MP))
    return spark.createDataFrame(rows, "feature string, value string, weight double")


def q_tx_count_300s(spark, sf_dir):
    """The reference's own window and cut-offs."""
    s = score_transactions(_tx(spark, sf_dir), REF)
    return s.select("transaction_id", "customer_id", "ts", "tx_count_5min")


def q_rule_label_reference(spark, sf_dir):
    s = score_transactions(_tx(spark, sf_dir), REF)
    return s.select("transaction_id", rule_label("amount", "country", "tx_count_5min", "category", REF).alias("label"))


def _batch_scored(spark, sf_dir):
    """The whole view as one micro-batch: counts within the batch."""
    counted = batch_customer_count(base_features(_tx(spark, sf_dir), P), out="_n")
    return score_linear(counted.withColumn("tx_count_5min", F.col("_n").cast("int")).drop("_n"), P)


def q_microbatch_enriched(spark, sf_dir):
    return enriched(_batch_scored(spark, sf_dir)).withColumn("amount_zscore", round_to("amount_zscore", 6))


def q_microbatch_alerts(spark, sf_dir):
    return build_alerts(_batch_scored(spark, sf_dir), P)


def q_keyed_new_rows(spark, sf_dir):
    """A batch of every transaction, half of them twice, against a table that
    holds the other half."""
    tx = _tx(spark, sf_dir)
    stored, rest = ml.hash_split(tx, 0.5, 1)
    return new_rows(tx.unionByName(rest), stored)


def q_stream_enriched(spark, sf_dir):
    """The current enriched rows that the stream leaves; z-scores are those of a
    row's batch, so they are left out."""
    sinks = streamed(_tx(spark, sf_dir), P)
    return current(read_table(spark, sinks.enriched, ENRICHED_SCHEMA)).select(*[f.name for f in ENRICHED_SCHEMA.fields if f.name != "amount_zscore"])


def q_stream_alerts(spark, sf_dir):
    """The current alerts that the stream leaves where a rising count takes alerts back."""
    sinks = streamed(_tx(spark, sf_dir), FALLING)
    return current(read_table(spark, sinks.alerts, ALERT_TABLE_SCHEMA)).select(*[f.name for f in ALERT_SCHEMA.fields])


def q_stream_minute_rates(spark, sf_dir):
    """The per-minute counts that the stream leaves, with the same falling scores."""
    sinks = streamed(_tx(spark, sf_dir), FALLING, minutes=True)
    return minute_totals(read_table(spark, sinks.minutes)).withColumn("alert_rate_pct", round_to("alert_rate_pct", 6))


def _view(spark, sf_dir):
    return monitor.view_filter(_scored(spark, sf_dir), VF)


def q_view_kpi_summary(spark, sf_dir):
    return monitor.kpi_summary(_view(spark, sf_dir), M)


def q_view_threshold_sweep(spark, sf_dir):
    return economics.threshold_sweep(_view(spark, sf_dir), S, C)


def q_view_sla_verdict(spark, sf_dir):
    rates = monitor.minute_rates(_view(spark, sf_dir), M.threshold)
    return monitor.sla_verdict(monitor.sla_rolling(rates, M.sla_window_minutes), M.sla_limit_pct)


def q_customer_drilldown(spark, sf_dir):
    """Summary and recommended action of one customer."""
    own = investigate.for_customer(_scored(spark, sf_dir), DRILLDOWN_CUSTOMER)
    summary = investigate.customer_summary(own, M.threshold)
    return summary.join(investigate.customer_actions(own, M.threshold, M.block_score), "customer_id")


def q_customer_series(spark, sf_dir):
    return investigate.customer_series(_scored(spark, sf_dir), DRILLDOWN_CUSTOMER)


def _wide_scored(spark, sf_dir, merchant: bool = False):
    """The wide benchmark fixture (lineitem ⋈ orders ⋈ customer ⋈ nation ⋈
    part, and supplier where the merchant is asked for), scored like the
    transactions view."""
    return score_transactions(wide_transactions(_tables(spark, sf_dir), merchant), P)


def q_wide_kpi_summary(spark, sf_dir):
    return monitor.kpi_summary(_wide_scored(spark, sf_dir), M)


def q_wide_threshold_sweep(spark, sf_dir):
    return economics.threshold_sweep(_wide_scored(spark, sf_dir), S, C)


def q_wide_hotspot_merchant(spark, sf_dir):
    return monitor.hotspots(monitor.flagged(_wide_scored(spark, sf_dir, merchant=True), M.threshold), "merchant", M.top_k_hotspots)


def q_wide_customer_summary(spark, sf_dir):
    return investigate.customer_summary(_wide_scored(spark, sf_dir), M.threshold)


QUERIES: dict[str, Query] = {
    "transactions": q_transactions,
    "base_features": q_base_features,
    "tx_count_5min": q_tx_count,
    "score_sql": q_score_sql,
    "alert_build": q_alert_build,
    "rule_label": q_rule_label,
    "enriched": q_enriched,
    "batch_customer_count": q_batch_customer_count,
    "amount_zscore": q_amount_zscore,
    "customer_zscore": q_customer_zscore,
    "key_violations": q_key_violations,
    "view_filter": q_view_filter,
    "flagged": q_flagged,
    "kpi_summary": q_kpi_summary,
    "minute_rates": q_minute_rates,
    "sla_rolling": q_sla_rolling,
    "sla_verdict": q_sla_verdict,
    "hotspot_country": q_hotspot_country,
    "hotspot_merchant": q_hotspot_merchant,
    "filter_options": q_filter_options,
    "amount_histogram": q_amount_histogram,
    "score_histogram": q_score_histogram,
    "latest_transactions": q_latest_transactions,
    "alert_detail": q_alert_detail,
    "recent_alerts": q_recent_alerts,
    "cost_model": q_cost_model,
    "threshold_sweep": q_threshold_sweep,
    "best_threshold": q_best_threshold,
    "customer_summary": q_customer_summary,
    "customer_top_country": q_customer_top_country,
    "customer_top_merchant": q_customer_top_merchant,
    "customer_timeline": q_customer_timeline,
    "customer_actions": q_customer_actions,
    "json_decode": q_json_decode,
    "quarantine_split": q_quarantine_split,
    "ts_parse": q_ts_parse,
    "score_accuracy": q_score_accuracy,
    "split_counts": q_split_counts,
    "string_index": q_string_index,
    "one_hot_rows": q_one_hot_rows,
    "value_index": q_value_index,
    "model_table_score": q_model_table_score,
    "model_score": q_model_score,
    "model_evaluation": q_model_evaluation,
    "model_calibration": q_model_calibration,
    "model_certificate": q_model_certificate,
    "model_auc": q_model_auc,
    "model_reloaded": q_model_reloaded,
    "fitted_score": q_fitted_score,
    "fitted_evaluation": q_fitted_evaluation,
    "model_coefficients": q_model_coefficients,
    "tx_count_300s": q_tx_count_300s,
    "rule_label_reference": q_rule_label_reference,
    "microbatch_enriched": q_microbatch_enriched,
    "microbatch_alerts": q_microbatch_alerts,
    "keyed_new_rows": q_keyed_new_rows,
    "stream_enriched": q_stream_enriched,
    "stream_alerts": q_stream_alerts,
    "stream_minute_rates": q_stream_minute_rates,
    "view_kpi_summary": q_view_kpi_summary,
    "view_threshold_sweep": q_view_threshold_sweep,
    "view_sla_verdict": q_view_sla_verdict,
    "customer_drilldown": q_customer_drilldown,
    "customer_series": q_customer_series,
    "wide_kpi_summary": q_wide_kpi_summary,
    "wide_threshold_sweep": q_wide_threshold_sweep,
    "wide_hotspot_merchant": q_wide_hotspot_merchant,
    "wide_customer_summary": q_wide_customer_summary,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    sql = oracle.oracle_queries(P, M, C, S, VF, REF, MP, COEFFICIENTS, DRILLDOWN_CUSTOMER, FALLING)
    return {k: v for k, v in sql.items() if k in QUERIES}
