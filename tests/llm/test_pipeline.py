"""The five stages together: what goes, what stays, and what the text becomes."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.helpers import docs, odd_rows, with_clashes
from tests.llm.test_decontam import brute as windows
from tests.llm.test_dedup import brute as groups
from txrisk.llm import bpe, pii, quality


def test_stages():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["stage_quality", "stage_dedup", "stage_decontamination", "stage_pii", "stage_bpe"]


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """The table that each stage leaves, the input first."""
    out = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp(f"stage{k}") / "out")
        stage(spark, out[-1], SMALL).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_each_stage_on_its_own_input(spark, outputs):
    start, good, single, clean, masked, coded = outputs
    for t in outputs[1:5]:
        assert t.columns == start.columns and t.schema == start.schema
    trees = quality.fit(start, spark.read.parquet(f"{SMALL}/labels.parquet"))
    want = quality.judge(start, trees, ["doc_id"]).filter("kept")
    assert ids(good) == ids(want)
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert ids(single) == sorted(i for (i, _), (_, low) in zip(rows, groups(rows)) if i == low)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert ids(clean) == sorted(r.doc_id for r in single.collect() if not windows(r.text, items)[1])
    assert len(ids(clean)) < len(ids(single)) < len(ids(good)) < start.count()
    before, after = ({r.doc_id: r for r in t.collect()} for t in (clean, masked))
    assert before.keys() == after.keys()
    for i, r in after.items():
        spans = pii.base_spans(before[i].text)
        assert (r.text == before[i].text) == (not spans) and r.n_chars == len(r.text)
        assert not pii.base_spans(r.text) or spans
    codec = bpe.codec(bpe.default_vocabulary())
    for r in coded.collect():
        assert codec.decode(r.ids) == after[r.doc_id].text and r.n_tokens == len(np.frombuffer(r.ids, "<u4"))
    assert ids(coded) == ids(masked)


def test_run_gives_the_last_table(spark, outputs):
    got = corpus_pipeline.run(spark, SMALL)
    cols = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, outputs[-1].select(*cols).collect()))


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_odd_rows_go_through_every_stage(spark):
    frame = with_clashes(docs(spark, odd_rows()))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, SMALL)
        n = out.count()
        assert n <= frame.count(), name
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == frame.columns
            assert stage(spark, frame.limit(0), SMALL).count() == 0
            assert out.filter(F.col("t") != "clash").count() == 0
