"""Session helpers: partition sizing, zone pinning, lineage cutting."""

from __future__ import annotations

from pyspark.sql import functions as F

from txrisk.session import checkpoint_dir, materialize, pin_utc, scale_conf


def test_scale_conf_targets_partition_size():
    conf = scale_conf(100 * 2**40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2**40 // 2**30
    assert conf["spark.shuffle.push.enabled"] == "true"
    small = scale_conf(10**6, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24  # never fewer than 3 tasks per core


def test_pin_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        pin_utc(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_materialize_cuts_lineage(spark):
    assert checkpoint_dir(spark)
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    cut = materialize(df)
    assert cut.count() == 100
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        cut.explain()
    assert "Range" not in buf.getvalue()  # read back from the checkpoint, not recomputed
