"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each query is written as plain SQL over the driver's tables, independent of
the Spark code. Parameter values come from the same dataclasses so both
sides use the same numbers. Doubles are rounded to 6 places on both sides
with the same rule, ``round(x·1e6) / 1e6``; probability mass is summed in
integer millionths.
"""

from __future__ import annotations

from txrisk.params import CostParams, ModelParams, MonitorParams, ScoringParams, SweepParams, ViewFilter


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_lit(v) for v in values) + ")"


def transactions_cte() -> str:
    return """transactions AS (
  SELECT CAST(e.event_id AS VARCHAR) AS transaction_id,
         concat('C', CASE WHEN length(CAST(e.user_id AS VARCHAR)) < 6 THEN lpad(CAST(e.user_id AS VARCHAR), 6, '0') ELSE CAST(e.user_id AS VARCHAR) END) AS customer_id,
         e.ts AS ts,
         CASE WHEN e.value IS NULL THEN NULL WHEN e.value < 1 THEN 1.0 ELSE round(e.value, 2) END AS amount,
         'EUR' AS currency,
         concat('M', CAST(TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 7 AS VARCHAR)) AS merchant,
         n.n_name AS country,
         e.event_type AS category
  FROM events e
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""


def wide_cte() -> str:
    return """wide AS (
  SELECT concat('C', CASE WHEN length(CAST(o.o_custkey AS VARCHAR)) < 6 THEN lpad(CAST(o.o_custkey AS VARCHAR), 6, '0') ELSE CAST(o.o_custkey AS VARCHAR) END) AS customer_id,
         l.l_shipdate AS ts,
         l.l_extendedprice AS amount,
         'EUR' AS currency,
         s.s_name AS merchant,
         n.n_name AS country,
         p.p_type AS category
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""


def features_cte(p: ScoringParams, src: str = "transactions") -> str:
    return f"""features AS (
  SELECT *,
         CAST(hour(ts) AS INTEGER) AS hour,
         COALESCE(CAST(country <> {_lit(p.home_country)} AS INTEGER), 0) AS is_foreign,
         ln(1 + amount) AS amount_log,
         CAST(count(*) OVER (PARTITION BY customer_id ORDER BY ts
              RANGE BETWEEN INTERVAL {p.window_seconds} SECONDS PRECEDING AND CURRENT ROW) AS INTEGER) AS tx_count_5min
  FROM {src}
)"""


def score_expr(p: ScoringParams) -> str:
    return (
        f"(round((1 / (1 + exp(-({p.intercept!r} + {p.coef_amount!r} * amount + {p.coef_tx_count!r} * tx_count_5min"
        f" + {p.coef_foreign!r} * is_foreign + CASE WHEN category = {_lit(p.special_category)}"
        f" THEN {p.coef_special_category!r} ELSE 0.0 END)))) * 1e{p.score_digits}) / 1e{p.score_digits})"
    )


def scored_cte(p: ScoringParams) -> str:
    return f"""scored AS (
  SELECT *, {score_expr(p)} AS risk_score FROM features
)"""


def base(p: ScoringParams) -> str:
    """WITH transactions, features, scored"""
    return "WITH " + ",\n".join([transactions_cte(), features_cte(p), scored_cte(p)])


def wide_base(p: ScoringParams) -> str:
    """WITH wide, features, scored — the benchmark fixture."""
    return "WITH " + ",\n".join([wide_cte(), features_cte(p, "wide"), scored_cte(p)])


def _d(x: float) -> str:
    """A DOUBLE literal (DuckDB reads 0.8 as DECIMAL)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def flagged_pred(threshold: float, score: str = "risk_score") -> str:
    return f"({score} >= {_d(threshold)} AND NOT isnan({score}))"


def prob_expr(score: str = "risk_score") -> str:
    return f"CASE WHEN isnan({score}) THEN NULL ELSE least(greatest({score}, 0.0), 1.0) END"


def micro(expr: str) -> str:
    """Probability in integer millionths (exact sums)."""
    return f"CAST(round(({expr}) * 1e6) AS BIGINT)"


def mass(sum_expr: str) -> str:
    return f"(CAST(coalesce({sum_expr}, 0) AS DOUBLE) / 1e6)"


def value_exprs(n_flag: str, p_flag: str, p_all: str, c: CostParams) -> dict[str, str]:
    fp = f"({n_flag} - {p_flag})"
    avoided = f"({p_flag} * {_d(c.block_efficiency)} * {_d(c.loss_per_fraud)})"
    costs = f"({n_flag} * {_d(c.review_cost)} + {fp} * {_d(c.false_positive_cost)})"
    return {
        "precision_est": f"{p_flag} / greatest(CAST({n_flag} AS DOUBLE), 1.0)",
        "recall_est": f"{p_flag} / greatest({p_all}, {_d(1e-9)})",
        "expected_fp": fp,
        "avoided_losses_est": avoided,
        "costs_est": costs,
        "net_value_est": f"({avoided} - {costs})",
    }


def rates_cte(threshold: float) -> str:
    return f"""rates AS (
  SELECT date_trunc('minute', ts) AS minute,
         count(transaction_id) AS tx,
         count(CASE WHEN {flagged_pred(threshold)} THEN 1 END) AS flagged,
         count(CASE WHEN {flagged_pred(threshold)} THEN 1 END) / greatest(CAST(count(transaction_id) AS DOUBLE), 1.0) * 100.0 AS alert_rate_pct
  FROM scored WHERE ts IS NOT NULL GROUP BY 1
)"""


def rolling_cte(n: int) -> str:
    return f"""roll AS (
  SELECT *, avg(alert_rate_pct) OVER (ORDER BY minute ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS sla_rate_pct
  FROM rates
)"""


def sweep_cte(s: SweepParams, c: CostParams) -> str:
    v = value_exprs("flagged", "p_flag", "p_all", c)
    return f"""grid AS (
  SELECT CAST(i AS DOUBLE) / CAST({s.scale} AS DOUBLE) AS threshold FROM generate_series({s.lo}, {s.hi}) g(i)
),
prob AS (SELECT risk_score, {micro(prob_expr())} AS p FROM scored),
total AS (SELECT {mass("sum(p)")} AS p_all FROM prob),
per_t AS (
  SELECT grid.threshold, count(prob.risk_score) AS flagged, {mass("sum(prob.p)")} AS p_flag
  FROM grid LEFT JOIN prob ON prob.risk_score >= grid.threshold AND NOT isnan(prob.risk_score)
  GROUP BY grid.threshold
),
sweep AS (
  SELECT threshold, flagged,
         (round(({v["precision_est"]}) * 1e6) / 1e6) AS precision_est,
         (round(({v["recall_est"]}) * 1e6) / 1e6) AS recall_est,
         (round(({v["net_value_est"]}) * 1e6) / 1e6) AS net_value_est,
         (round(({v["avoided_losses_est"]}) * 1e6) / 1e6) AS avoided_losses_est,
         (round(({v["costs_est"]}) * 1e6) / 1e6) AS costs_est
  FROM per_t, total
)"""


def histogram_sql(src: str, column: str, bins: int) -> str:
    w = f"((hi - lo) / CAST({bins} AS DOUBLE))"
    return f""",
bounds AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {src}),
binned AS (
  SELECT CAST(least(CASE WHEN {w} > 0 THEN floor(({column} - lo) / {w}) ELSE 0 END, {bins - 1}) AS INTEGER) AS bin,
         lo, {w} AS w
  FROM {src}, bounds WHERE {column} IS NOT NULL
)
SELECT bin, (round((lo + bin * w) * 1e6) / 1e6) AS lower, (round((lo + (bin + 1) * w) * 1e6) / 1e6) AS upper, count(*) AS n
FROM binned GROUP BY bin, lo, w"""


def reason_expr(p: ScoringParams) -> str:
    return (
        f"CASE WHEN amount > {p.high_amount!r} THEN 'High amount'"
        f" WHEN country IN {_in(p.risky_countries)} THEN 'Risky country'"
        f" ELSE 'Model flag' END"
    )


def severity_expr(p: ScoringParams) -> str:
    return (
        f"CASE WHEN risk_score >= {p.high_severity!r} THEN 'HIGH'"
        f" WHEN risk_score >= {p.medium_severity!r} THEN 'MEDIUM' ELSE 'LOW' END"
    )


def label_expr(p: ScoringParams) -> str:
    return (
        f"CAST(COALESCE(amount > {p.high_amount!r}"
        f" OR (country IN {_in(p.risky_countries)} AND tx_count_5min >= {p.risky_count})"
        f" OR (category = {_lit(p.special_category)} AND amount > {p.special_amount!r}), false) AS INTEGER)"
    )


def oracle_queries(
    p: ScoringParams,
    m: MonitorParams,
    c: CostParams,
    s: SweepParams,
    vf: ViewFilter,
    ref: ScoringParams,
    mp: ModelParams,
    coefs: dict,
    customer: str,
    falling: ScoringParams,
) -> dict[str, str]:
    B = base(p)
    q: dict[str, str] = {}

    q["transactions"] = "WITH " + transactions_cte() + "\nSELECT * FROM transactions"

    q["base_features"] = B + """
SELECT transaction_id, hour, is_foreign, (round((amount_log) * 1e6) / 1e6) AS amount_log FROM features"""

    q["tx_count_5min"] = B + """
SELECT transaction_id, customer_id, ts, tx_count_5min FROM features"""

    q["score_sql"] = B + """
SELECT transaction_id, risk_score FROM scored"""

    q["alert_build"] = B + f"""
SELECT transaction_id, ts, risk_score, {reason_expr(p)} AS reason, {severity_expr(p)} AS severity
FROM scored WHERE {flagged_pred(p.alert_threshold)}"""

    q["rule_label"] = B + f"""
SELECT transaction_id, {label_expr(p)} AS label FROM scored"""

    q["enriched"] = B + """
SELECT transaction_id, customer_id, ts, amount, currency, merchant, country, category, tx_count_5min,
       (round(((amount - avg(amount) OVER ()) / NULLIF(stddev_samp(amount) OVER (), 0)) * 1e6) / 1e6) AS amount_zscore,
       risk_score
FROM scored"""

    q["batch_customer_count"] = "WITH " + transactions_cte() + """
SELECT transaction_id, customer_id, count(*) OVER (PARTITION BY customer_id) AS batch_tx_count FROM transactions"""

    q["amount_zscore"] = "WITH " + transactions_cte() + """
SELECT transaction_id, amount,
       (round(((amount - avg(amount) OVER ()) / NULLIF(stddev_samp(amount) OVER (), 0)) * 1e6) / 1e6) AS amount_zscore
FROM transactions"""

    q["customer_zscore"] = "WITH " + transactions_cte() + """
SELECT transaction_id, customer_id, amount,
       (round(((amount - avg(amount) OVER (PARTITION BY customer_id))
             / NULLIF(stddev_samp(amount) OVER (PARTITION BY customer_id), 0)) * 1e6) / 1e6) AS customer_zscore
FROM transactions"""

    q["key_violations"] = B + """,
k AS (SELECT transaction_id, count(*) AS n FROM scored GROUP BY transaction_id)
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows,
       count(transaction_id) AS n_keys,
       CAST(coalesce(sum(CASE WHEN transaction_id IS NULL THEN n END), 0) AS BIGINT) AS n_null_keys,
       count(CASE WHEN transaction_id IS NOT NULL AND n > 1 THEN 1 END) AS n_duplicate_keys
FROM k"""

    view_cols = "ts, transaction_id, customer_id, amount, country, merchant, category, risk_score"
    conds = [f"{name} IN {_in(vals)}" for name, vals in
             (("country", vf.countries), ("merchant", vf.merchants), ("category", vf.categories)) if vals]
    q["view_filter"] = B + f"""
SELECT {view_cols} FROM scored WHERE {" AND ".join(conds) if conds else "true"}"""

    q["flagged"] = B + f"""
SELECT {view_cols} FROM scored WHERE {flagged_pred(m.threshold)}"""

    rate = "n_flagged / greatest(CAST(n_tx AS DOUBLE), 1.0) * 100.0"
    q["kpi_summary"] = B + f""",
k AS (SELECT count(*) AS n_tx, count(CASE WHEN {flagged_pred(m.threshold)} THEN 1 END) AS n_flagged FROM scored)
SELECT n_tx, n_flagged, (round(({rate}) * 1e6) / 1e6) AS alert_rate_pct,
       CASE WHEN {rate} >= {_d(m.level_high_pct)} THEN 'HIGH'
            WHEN {rate} >= {_d(m.level_moderate_pct)} THEN 'MODERATE' ELSE 'LOW' END AS risk_level
FROM k"""

    R = B + ",\n" + rates_cte(m.threshold)
    q["minute_rates"] = R + """
SELECT minute, tx, flagged, (round((alert_rate_pct) * 1e6) / 1e6) AS alert_rate_pct FROM rates"""

    RR = R + ",\n" + rolling_cte(m.sla_window_minutes)
    q["sla_rolling"] = RR + """
SELECT minute, tx, flagged, (round((alert_rate_pct) * 1e6) / 1e6) AS alert_rate_pct, (round((sla_rate_pct) * 1e6) / 1e6) AS sla_rate_pct FROM roll"""

    q["sla_verdict"] = RR + f"""
SELECT max(minute) AS latest_minute,
       (round((coalesce(arg_max(sla_rate_pct, minute), 0.0)) * 1e6) / 1e6) AS sla_rate_pct,
       {_d(m.sla_limit_pct)} AS limit_pct,
       coalesce(arg_max(sla_rate_pct, minute), 0.0) > {_d(m.sla_limit_pct)} AS breach
FROM roll"""

    for col in ("country", "merchant"):
        q[f"hotspot_{col}"] = B + f"""
SELECT {col}, count(*) AS n_flagged FROM scored
WHERE {flagged_pred(m.threshold)} AND {col} IS NOT NULL
GROUP BY {col} ORDER BY n_flagged DESC, {col} ASC LIMIT {m.top_k_hotspots}"""

    q["filter_options"] = "WITH " + transactions_cte() + """
SELECT DISTINCT field, value FROM (
  SELECT 'country' AS field, country AS value FROM transactions
  UNION ALL SELECT 'merchant', merchant FROM transactions
  UNION ALL SELECT 'category', category FROM transactions
  UNION ALL SELECT 'customer_id', customer_id FROM transactions
) WHERE value IS NOT NULL ORDER BY field, value"""

    q["amount_histogram"] = "WITH " + transactions_cte() + histogram_sql("transactions", "amount", m.amount_bins)
    q["score_histogram"] = B + histogram_sql("scored", "risk_score", m.score_bins)

    q["latest_transactions"] = B + f"""
SELECT {view_cols} FROM scored ORDER BY ts DESC NULLS LAST, transaction_id ASC LIMIT {m.recent_rows}"""

    detail = B + f""",
alerts AS (
  SELECT transaction_id, ts, risk_score, {reason_expr(p)} AS reason, {severity_expr(p)} AS severity
  FROM scored WHERE {flagged_pred(p.alert_threshold)}
),
detail AS (
  SELECT a.ts, a.transaction_id, a.severity, a.risk_score, a.reason, t.country, t.merchant, t.amount
  FROM alerts a JOIN scored t ON a.transaction_id = t.transaction_id
)"""
    q["alert_detail"] = detail + "\nSELECT * FROM detail"
    q["recent_alerts"] = detail + f"""
SELECT * FROM detail ORDER BY ts DESC NULLS LAST, transaction_id ASC LIMIT {m.recent_rows}"""

    v = value_exprs("n_flagged", "pf", "tot", c)
    q["cost_model"] = B + f""",
pr AS (SELECT {flagged_pred(m.threshold)} AS f, {micro(prob_expr())} AS p FROM scored),
a AS (SELECT count(*) AS n_tx, count(CASE WHEN f THEN 1 END) AS n_flagged,
             {mass("sum(p)")} AS tot, {mass("sum(CASE WHEN f THEN p END)")} AS pf FROM pr)
SELECT n_tx, n_flagged,
       (round((tot) * 1e6) / 1e6) AS expected_total_fraud,
       (round((pf) * 1e6) / 1e6) AS expected_fraud_flagged,
       (round(({v["expected_fp"]}) * 1e6) / 1e6) AS expected_fp_flagged,
       (round((tot - pf) * 1e6) / 1e6) AS expected_missed_fraud,
       (round((pf * {_d(c.block_efficiency)}) * 1e6) / 1e6) AS expected_stopped_fraud,
       (round(({v["avoided_losses_est"]}) * 1e6) / 1e6) AS avoided_losses_est,
       (round(({v["costs_est"]}) * 1e6) / 1e6) AS costs_est,
       (round(({v["net_value_est"]}) * 1e6) / 1e6) AS net_value_est
FROM a"""

    SW = B + ",\n" + sweep_cte(s, c)
    q["threshold_sweep"] = SW + "\nSELECT * FROM sweep"
    q["best_threshold"] = SW + "\nSELECT * FROM sweep ORDER BY net_value_est DESC, threshold ASC LIMIT 1"

    q["customer_summary"] = B + f"""
SELECT customer_id, count(*) AS n_tx,
       count(CASE WHEN {flagged_pred(m.threshold)} THEN 1 END) AS n_flagged,
       (round((sum(amount)) * 1e6) / 1e6) AS total_amount, max(risk_score) AS max_score
FROM scored GROUP BY customer_id"""

    for col in ("country", "merchant"):
        q[f"customer_top_{col}"] = B + f""",
cnt AS (SELECT customer_id, {col}, count(*) AS n FROM scored WHERE {col} IS NOT NULL GROUP BY customer_id, {col}),
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, {col} ASC) AS INTEGER) AS rank FROM cnt)
SELECT customer_id, {col}, n, rank FROM rk WHERE rank <= {m.top_k_profile}"""

    q["customer_timeline"] = B + f""",
tl AS (
  SELECT customer_id, ts, transaction_id, amount, country, merchant, category, risk_score,
         CAST(row_number() OVER (PARTITION BY customer_id ORDER BY ts DESC NULLS LAST, transaction_id ASC) AS INTEGER) AS rn
  FROM scored
)
SELECT * FROM tl WHERE rn <= {m.timeline_rows}"""

    hi = max(m.block_score, m.threshold)
    q["customer_actions"] = B + f""",
ca AS (
  SELECT customer_id,
         count(CASE WHEN {flagged_pred(hi)} THEN 1 END) AS n_high,
         count(CASE WHEN {flagged_pred(m.threshold)} AND risk_score < {_d(m.block_score)} THEN 1 END) AS n_mid
  FROM scored GROUP BY customer_id
)
SELECT customer_id, n_high, n_mid,
       CASE WHEN n_high > 0 THEN 'BLOCK_AND_INVESTIGATE' WHEN n_mid > 0 THEN 'MANUAL_REVIEW'
            ELSE 'STANDARD_MONITORING' END AS action
FROM ca"""

    # ------------------------------------------------ wide benchmark fixture
    WB = wide_base(p)
    q["wide_kpi_summary"] = WB + f""",
k AS (SELECT count(*) AS n_tx, count(CASE WHEN {flagged_pred(m.threshold)} THEN 1 END) AS n_flagged FROM scored)
SELECT n_tx, n_flagged, (round(({rate}) * 1e6) / 1e6) AS alert_rate_pct,
       CASE WHEN {rate} >= {_d(m.level_high_pct)} THEN 'HIGH'
            WHEN {rate} >= {_d(m.level_moderate_pct)} THEN 'MODERATE' ELSE 'LOW' END AS risk_level
FROM k"""
    q["wide_threshold_sweep"] = WB + ",\n" + sweep_cte(s, c) + "\nSELECT * FROM sweep"
    q["wide_hotspot_merchant"] = WB + f"""
SELECT merchant, count(*) AS n_flagged FROM scored
WHERE {flagged_pred(m.threshold)} AND merchant IS NOT NULL
GROUP BY merchant ORDER BY n_flagged DESC, merchant ASC LIMIT {m.top_k_hotspots}"""
    q["wide_customer_summary"] = WB + f"""
SELECT customer_id, count(*) AS n_tx,
       count(CASE WHEN {flagged_pred(m.threshold)} THEN 1 END) AS n_flagged,
       (round((sum(amount)) * 1e6) / 1e6) AS total_amount, max(risk_score) AS max_score
FROM scored GROUP BY customer_id"""

    q["json_decode"] = "WITH " + transactions_cte() + "\nSELECT * FROM transactions"

    msg = ("json_object('transaction_id', transaction_id, 'customer_id', customer_id,"
           " 'ts', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00'), 'amount', amount, 'currency', currency,"
           " 'merchant', merchant, 'country', country, 'category', category)")
    missing = " OR ".join(f"json_extract_string(value, '$.{f}') IS NULL"
                          for f in ("transaction_id", "customer_id", "ts", "amount"))
    q["quarantine_split"] = "WITH " + transactions_cte() + f""",
msgs AS (
  SELECT CAST({msg} AS VARCHAR) AS value FROM transactions
  UNION ALL SELECT props FROM events
  UNION ALL SELECT text FROM documents
  UNION ALL SELECT '{{"transaction_id":"c' || c_custkey || '","customer_id":"C1","ts":"soon","amount":1.0}}' FROM customer
  UNION ALL SELECT '{{"transaction_id":"s' || s_suppkey || '","customer_id":"C1","ts":"2024-01-01T00:00:00+00:00","amount":NaN}}' FROM supplier
  UNION ALL SELECT CAST(NULL AS VARCHAR) FROM nation
),
tagged AS (
  SELECT CASE
           WHEN value IS NULL THEN 'null_message'
           WHEN ends_with(value, '"amount":NaN}}') THEN 'bad_amount'
           WHEN NOT json_valid(value) THEN 'malformed_json'
           WHEN {missing} THEN 'missing_field'
           WHEN TRY_CAST(json_extract_string(value, '$.ts') AS TIMESTAMPTZ) IS NULL THEN 'bad_timestamp'
         END AS reason
  FROM msgs
)
SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n FROM tagged GROUP BY 1"""

    q["ts_parse"] = "WITH " + transactions_cte() + """,
t AS (SELECT transaction_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ts_text FROM transactions)
SELECT transaction_id, ts_text, timezone('UTC', TRY_CAST(ts_text AS TIMESTAMPTZ)) AS ts FROM t"""

    q["score_accuracy"] = B + f""",
lab AS (SELECT risk_score, {label_expr(p)} AS label FROM scored)
SELECT count(*) AS n,
       count(CASE WHEN label = 1 THEN 1 END) AS n_positive,
       count(CASE WHEN risk_score >= 0.5 THEN 1 END) AS n_predicted,
       (round((avg(CASE WHEN (risk_score >= 0.5 AND label = 1) OR (risk_score < 0.5 AND label = 0) THEN 1 ELSE 0 END)) * 1e6) / 1e6) AS accuracy
FROM lab"""

    # ------------------------------------------------ model
    LAB = B + f""",
lab AS (SELECT * EXCLUDE (risk_score), {label_expr(p)} AS label FROM scored)"""
    first = f"CAST(('0x' || substr(md5('{mp.split_seed}:' || transaction_id), 1, 8)) AS BIGINT) < {int(mp.train_fraction * 2**32)}"
    q["split_counts"] = LAB + f"""
SELECT CASE WHEN {first} THEN 'train' ELSE 'test' END AS part, count(*) AS n, count(CASE WHEN label = 1 THEN 1 END) AS n_positive
FROM lab GROUP BY 1"""
    cells = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value FROM transactions" for c in mp.categorical)
    ranked = "WITH " + transactions_cte() + f""",
cell AS ({cells}),
cnt AS (SELECT feature, value, count(*) AS n FROM cell GROUP BY feature, value),
ranked AS (SELECT feature, value, n, CAST(row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) - 1 AS INTEGER) AS index FROM cnt)"""
    q["string_index"] = ranked + "\nSELECT feature, value, n, index FROM ranked"
    q["value_index"] = q["string_index"]
    q["one_hot_rows"] = ranked + "\nSELECT feature, index AS slot, n FROM ranked"
    z = " + ".join([repr(coefs["intercept"]), *[f"{w!r} * {c}" for c, w in coefs["numeric"].items()]])
    for c, table in coefs["categorical"].items():
        z += f" + CASE {c} " + " ".join(f"WHEN {_lit(k)} THEN {w!r}" for k, w in table.items()) + " ELSE 0.0 END"
    TAB = LAB + f""",
tab AS (SELECT transaction_id, label, (round((1 / (1 + exp(-(CAST({z} AS DOUBLE))))) * 1e6) / 1e6) AS risk_score FROM lab)"""
    q["model_score"] = TAB + "\nSELECT * FROM tab"
    q["model_table_score"] = q["model_score"]
    q["model_evaluation"] = TAB + f"""
SELECT count(*) AS n, count(CASE WHEN label = 1 THEN 1 END) AS n_positive, count(CASE WHEN risk_score >= 0.5 THEN 1 END) AS n_predicted,
       (round((avg(CASE WHEN (risk_score >= 0.5) = (label = 1) THEN 1 ELSE 0 END)) * 1e6) / 1e6) AS accuracy
FROM tab WHERE NOT {first}"""
    q["model_calibration"] = LAB + f"""
SELECT count(*) AS n, (round((avg(label)) * 1e3) / 1e3) AS mean_score FROM lab WHERE {first}"""

    q["model_auc"] = TAB + f""",
per AS (SELECT risk_score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM tab WHERE NOT {first} GROUP BY 1),
below AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY risk_score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower FROM per)
SELECT CAST(sum(pos + neg) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS n_positive,
       (round((CAST(sum(pos * (lower + neg / 2)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE))) * 1e6) / 1e6) AS auc
FROM below"""
    # the moments that the labels set; every one has to be met by the fitted model
    numbers = " UNION ALL ".join(f"SELECT '{c}' AS feature, '' AS value, CAST({c} AS DOUBLE) AS x, label FROM train" for c in mp.numeric)
    slots = " UNION ALL ".join(f"SELECT '{c}', {c}, 1.0, label FROM train WHERE {c} IS NOT NULL" for c in mp.categorical)
    sigma = "sqrt((sum(x * x) - sum(x) * sum(x) / max(n)) / (max(n) - 1))"
    q["model_certificate"] = LAB + f""",
train AS (SELECT * FROM lab WHERE {first}),
cell AS ({numbers} UNION ALL {slots}),
size AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM train)
SELECT 'intercept' AS feature, '' AS value, CAST(1 AS DOUBLE) AS sigma, (round(avg(label) * 1e6) / 1e6) AS label_moment, true AS optimal FROM train
UNION ALL
SELECT feature, value, (round({sigma} * 1e6) / 1e6), (round(coalesce(sum(x * label) / max(n) / nullif({sigma}, 0), 0) * 1e6) / 1e6), true
FROM cell, size GROUP BY feature, value"""
    q["model_reloaded"] = LAB + """
SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_changed FROM lab"""

    # ------------------------------------------------ the stream's tables
    F = base(falling)
    q["stream_enriched"] = B + """
SELECT transaction_id, customer_id, ts, amount, currency, merchant, country, category, tx_count_5min, risk_score FROM scored"""
    q["stream_alerts"] = F + q["alert_build"][len(B):]
    q["stream_minute_rates"] = F + ",\n" + rates_cte(falling.alert_threshold) + """
SELECT minute, tx, flagged, (round((alert_rate_pct) * 1e6) / 1e6) AS alert_rate_pct FROM rates"""

    # ------------------------------------------------ reference window, micro-batch, keyed rows
    REF = base(ref)
    q["tx_count_300s"] = REF + """
SELECT transaction_id, customer_id, ts, tx_count_5min FROM features"""
    q["rule_label_reference"] = REF + f"""
SELECT transaction_id, {label_expr(ref)} AS label FROM features"""
    MB = "WITH " + transactions_cte() + f""",
features AS (
  SELECT *, COALESCE(CAST(country <> {_lit(p.home_country)} AS INTEGER), 0) AS is_foreign,
         CAST(count(*) OVER (PARTITION BY customer_id) AS INTEGER) AS tx_count_5min
  FROM transactions
),
""" + scored_cte(p)
    q["microbatch_enriched"] = MB + q["enriched"][len(B):]
    q["microbatch_alerts"] = MB + q["alert_build"][len(B):]
    q["keyed_new_rows"] = "WITH " + transactions_cte() + f"""
SELECT * FROM transactions WHERE NOT CAST(('0x' || substr(md5('1:' || transaction_id), 1, 8)) AS BIGINT) < {2**31}"""

    # ------------------------------------------------ filtered view, drill-down
    V = B.replace("scored AS (", "scored_all AS (") + f""",
scored AS (SELECT * FROM scored_all WHERE {" AND ".join(conds) if conds else "true"})"""
    for name in ("kpi_summary", "threshold_sweep", "sla_verdict"):
        q[f"view_{name}"] = V + q[name][len(B):]
    own = f"customer_id = {_lit(customer)}"
    q["customer_drilldown"] = (
        q["customer_summary"].replace("SELECT customer_id, count(*) AS n_tx", "SELECT customer_id, n_tx, n_flagged, total_amount, max_score, n_high, n_mid, action FROM (SELECT customer_id, count(*) AS n_tx")
        + ") JOIN (" + q["customer_actions"][len(B) + 1:].replace("\nca AS", "WITH ca AS", 1) + f") USING (customer_id) WHERE {own}"
    )
    q["customer_series"] = B + f"""
SELECT ts, transaction_id, amount, risk_score FROM scored WHERE {own} AND ts IS NOT NULL"""

    return q
