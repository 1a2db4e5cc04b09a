"""Property tests: distributed operators against brute force on random data."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from txrisk.operators import monitor
from txrisk.operators.features import trailing_count, trailing_count_grains

T0 = dt.datetime(2026, 1, 1)
SCHEMA = "transaction_id string, customer_id string, ts timestamp_ntz"

events = st.lists(
    st.tuples(st.sampled_from(["C1", "C2", "C3"]), st.integers(min_value=0, max_value=4000)),
    min_size=1,
    max_size=40,
)


def brute_counts(data, window_s):
    out = {}
    for i, (c, s) in enumerate(data):
        out[str(i)] = sum(1 for (c2, s2) in data if c2 == c and s - window_s <= s2 <= s)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=events, window_s=st.sampled_from([1, 60, 300, 900]), factor=st.sampled_from([1, 2, 4, 7]))
def test_trailing_count_equals_brute_force(spark, data, window_s, factor):
    df = spark.createDataFrame(
        [(str(i), c, T0 + dt.timedelta(seconds=s)) for i, (c, s) in enumerate(data)], SCHEMA
    )
    got = {r.transaction_id: r.tx_count_5min
           for r in trailing_count(df, window_s * 10**6, factor).collect()}
    assert got == brute_counts(data, window_s)
    for grain_s in (7, 300, 5000):
        got = {r.transaction_id: r.tx_count_5min for r in trailing_count_grains(df, window_s * 10**6, grain_s * 10**6).collect()}
        assert got == brute_counts(data, window_s)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    minutes=st.lists(st.integers(min_value=0, max_value=5 * 1440), min_size=1, max_size=40, unique=True),
    n=st.integers(min_value=1, max_value=15),
    seed=st.integers(min_value=0, max_value=10**6),
)
def test_sla_rolling_equals_pandas_rolling(spark, minutes, n, seed):
    rnd = random.Random(seed)
    data = [(T0 + dt.timedelta(minutes=m), 1, 0, float(rnd.randint(0, 100))) for m in sorted(minutes)]
    df = spark.createDataFrame(data, "minute timestamp_ntz, tx long, flagged long, alert_rate_pct double")
    got = {r.minute: r.sla_rate_pct for r in monitor.sla_rolling(df, n).collect()}
    pdf = pd.DataFrame(data, columns=["minute", "tx", "flagged", "rate"]).sort_values("minute")
    want = pdf["rate"].rolling(window=n, min_periods=1).mean().tolist()
    for (m, *_), w in zip(data, want):
        assert abs(got[m] - w) < 1e-9


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    scores=st.lists(
        st.one_of(
            st.integers(min_value=0, max_value=10**6).map(lambda k: round(k / 1e6, 6)),
            st.integers(min_value=45, max_value=100).map(lambda k: k / 100),  # exactly on the grid
        ),
        min_size=1, max_size=60,
    ),
    at=st.lists(st.integers(min_value=50, max_value=99), min_size=2, max_size=2, unique=True),
)
def test_sweep_row_equals_cost_model_at_its_threshold(spark, scores, at):
    from txrisk.operators.economics import cost_model, threshold_sweep
    from txrisk.params import CostParams, SweepParams

    s, c = SweepParams(), CostParams()
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(scores)], "transaction_id string, risk_score double")
    got = {r.threshold: r for r in threshold_sweep(df, s, c).collect()}
    for k in at:
        row, one = got[k / 100], cost_model(df, k / 100, c).first()
        assert (row.flagged, row.net_value_est, row.avoided_losses_est, row.costs_est) == (
            one.n_flagged, one.net_value_est, one.avoided_losses_est, one.costs_est)
    flagged = [got[t].flagged for t in sorted(got)]
    assert flagged == sorted(flagged, reverse=True)
