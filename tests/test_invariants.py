"""Invariants between operators over the whole sf0.001 tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import SMALL
from txrisk.operators import economics, monitor
from txrisk.operators.alerts import build_alerts
from txrisk.operators.scoring import enriched, score_transactions
from txrisk.params import CostParams, ScoringParams, SweepParams
from txrisk.sources import messages
from txrisk.sources.tables import Tables
from txrisk.sources.transactions import transactions


def scored(spark):
    return score_transactions(transactions(Tables(spark, SMALL)), ScoringParams.fixture())


def test_sweep_monotone_and_matches_cost_model(spark):
    s = scored(spark)
    sweep = economics.threshold_sweep(s, SweepParams(), CostParams()).orderBy("threshold").collect()
    flagged = [r.flagged for r in sweep]
    assert flagged == sorted(flagged, reverse=True)
    assert all(0.0 <= r.recall_est <= 1.0 + 1e-9 for r in sweep)
    at80 = next(r for r in sweep if r.threshold == 0.8)
    cm = economics.cost_model(s, 0.8, CostParams()).first()
    assert cm.n_flagged == at80.flagged
    assert abs(cm.net_value_est - at80.net_value_est) < 1e-6


def test_minute_totals(spark):
    s = scored(spark)
    rates = monitor.minute_rates(s, 0.8)
    tot = rates.agg(F.sum("tx"), F.sum("flagged")).first()
    assert tot[0] == s.filter(F.col("ts").isNotNull()).count()
    assert tot[1] == s.filter(F.col("risk_score") >= 0.8).count()


def test_alerts_subset_of_enriched(spark):
    s = scored(spark)
    e = enriched(s)
    a = build_alerts(s, ScoringParams.fixture())
    assert a.join(e, "transaction_id", "left_anti").count() == 0
    assert e.count() == transactions(Tables(spark, SMALL)).count()


def test_quarantine_plus_accepted_is_input(spark):
    tx = transactions(Tables(spark, SMALL))
    raw = messages.to_messages(tx).unionByName(Tables(spark, SMALL)("events", "props").select(F.col("props").alias("value")))
    accepted, quarantined = messages.split(messages.decode(raw))
    assert accepted.count() + quarantined.count() == raw.count()
    assert accepted.count() == tx.count()
