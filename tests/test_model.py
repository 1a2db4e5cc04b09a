"""ML pipeline: fit, coefficient twin, unseen categories, save/load."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from txrisk.operators import model as ml
from txrisk.operators.scoring import score_transactions
from txrisk.params import ModelParams, ScoringParams
from txrisk.sources.tables import Tables
from txrisk.sources.transactions import transactions

MP = ModelParams()


@pytest.fixture(scope="module")
def fitted(spark):
    data = ml.with_label(score_transactions(transactions(Tables(spark, SMALL)), ScoringParams.fixture()), ScoringParams.fixture())
    data = data.drop("risk_score")
    train, test = ml.hash_split(data, MP.train_fraction, MP.split_seed)
    return ml.fit(train, MP), data, train, test


def test_split_is_a_partition_and_stable(spark, fitted):
    _, data, train, test = fitted
    n = data.count()
    assert train.count() + test.count() == n
    assert train.join(test, "transaction_id", "inner").count() == 0
    again, _ = ml.hash_split(data.repartition(5), MP.train_fraction, MP.split_seed)
    assert sorted(r[0] for r in again.select("transaction_id").collect()) == \
        sorted(r[0] for r in train.select("transaction_id").collect())
    assert 0.7 < train.count() / n < 0.9


def test_coefficient_twin_equals_pipeline(spark, fitted):
    model, data, _, _ = fitted
    coefs = ml.coefficients(model, MP)
    scored = ml.score_model(model, data).withColumn("twin", ml.coefficient_score(coefs))
    worst = scored.agg(F.max(F.abs(F.col("risk_score") - F.col("twin")))).first()[0]
    assert worst < 1e-9


def test_unseen_and_null_category_score(spark, fitted):
    model, data, _, _ = fitted
    coefs = ml.coefficients(model, MP)
    row = data.limit(1).collect()[0].asDict()
    variants = [dict(row, transaction_id="u1", category="never-seen"), dict(row, transaction_id="u2", category=None),
                dict(row, transaction_id="u3", country="ATLANTIS", merchant=None)]
    df = spark.createDataFrame(variants, data.schema)
    out = ml.score_model(model, df).withColumn("twin", ml.coefficient_score(coefs)).collect()
    for r in out:
        assert 0.0 <= r.risk_score <= 1.0
        assert abs(r.risk_score - r.twin) < 1e-9
    # unseen and NULL share the dropped slot: same score
    assert abs(out[0].risk_score - out[1].risk_score) < 1e-12


def test_refit_is_deterministic(spark, fitted):
    model, _, train, _ = fitted
    again = ml.fit(train, MP)
    a, b = ml.coefficients(model, MP), ml.coefficients(again, MP)
    assert a["intercept"] == pytest.approx(b["intercept"], abs=1e-9)
    for k in a["numeric"]:
        assert a["numeric"][k] == pytest.approx(b["numeric"][k], abs=1e-9)


def test_save_load_roundtrip(spark, fitted, scratch):
    model, data, _, test = fitted
    path = os.path.join(scratch, "model")
    ml.save(model, path)
    loaded = ml.load(path)
    a = ml.score_model(model, test).select("transaction_id", F.col("risk_score").alias("a"))
    b = ml.score_model(loaded, test).select("transaction_id", F.col("risk_score").alias("b"))
    assert a.join(b, "transaction_id").filter(F.abs(F.col("a") - F.col("b")) > 1e-12).count() == 0


def test_evaluation_and_auc(spark, fitted):
    model, _, _, test = fitted
    pred = ml.score_model(model, test)
    ev = ml.evaluate(pred).first()
    assert ev.n == test.count() and 0.0 <= ev.accuracy <= 1.0
    assert 0.5 <= ml.auc(pred) <= 1.0


def test_streaming_job_can_score_with_model(spark, fitted, scratch):
    from txrisk.streaming.job import ScoringJob, SinkPaths

    model, _, _, _ = fitted
    msg = ('{"transaction_id":"m1","customer_id":"C000001","ts":"2024-01-05T10:00:00+00:00","amount":50.0,'
           '"currency":"EUR","merchant":"M1","country":"NATION_3","category":"purchase"}')
    sinks = SinkPaths(os.path.join(scratch, "e"), os.path.join(scratch, "a"))
    ScoringJob(sinks, model=model).process(spark.createDataFrame([(msg,)], "value string"), 0)
    out = spark.read.parquet(sinks.enriched).first()
    assert out.transaction_id == "m1" and 0.0 <= out.risk_score <= 1.0
    assert out.ts == dt.datetime(2024, 1, 5, 10, 0, 0)


def test_certificate_tells_an_unfinished_fit(spark):
    from dataclasses import replace

    from txrisk.params import ModelParams

    mp = ModelParams()
    p = ScoringParams.fixture()
    data = ml.with_label(score_transactions(transactions(Tables(spark, SMALL)), p), p).select(*ml.TRAINING_COLUMNS)
    good = ml.optimality(data, ml.coefficients(ml.fit(data, mp), mp), mp, 1e-4)
    assert good.filter("not optimal").count() == 0 and good.count() > 12
    for wrong in (replace(mp, max_iter=2), replace(mp, reg_param=0.05)):
        off = ml.optimality(data, ml.coefficients(ml.fit(data, wrong), wrong), mp, 1e-4)
        assert off.filter("not optimal").count() > 0


def test_exact_auc_equals_all_pairs(spark):
    import random

    rnd = random.Random(5)
    rows = [(rnd.choice([0.1, 0.5, 0.9]) if rnd.random() < 0.3 else rnd.random(), rnd.randint(0, 1)) for _ in range(3000)]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    odd = [(None, 1), (float("nan"), 0), (0.4, None)]
    got = ml.exact_auc(spark.createDataFrame(rows + odd, "risk_score double, label int")).first()
    assert (got.n, got.n_positive) == (3000, len(pos)) and abs(got.auc - want) < 1e-6
    for few in ([], [(0.5, 1)], [(0.5, 0), (0.5, 0)]):
        assert ml.exact_auc(spark.createDataFrame(few, "risk_score double, label int")).first().auc is None


def test_value_index_over_many_values_and_partitions(spark):
    from collections import Counter

    from txrisk.params import ModelParams

    rows = [(f"v{i * i % 701}", "one", None if i % 3 else f"m{i % 50}") for i in range(5000)]
    got = ml.value_index(spark.createDataFrame(rows, "country string, category string, merchant string"), ModelParams())
    want = []
    for j, feature in enumerate(("country", "category", "merchant")):
        counts = Counter(r[j] for r in rows if r[j] is not None)
        want += [(feature, v, n, i) for i, (v, n) in enumerate(sorted(counts.items(), key=lambda kv: (-kv[1], kv[0])))]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
