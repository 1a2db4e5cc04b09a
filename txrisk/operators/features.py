"""Per-transaction features: hour, foreign flag, log amount, counts, z-scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.columns import epoch_micros, foreign_flag, hour_of_day, log_amount
from txrisk.params import ScoringParams

COUNT_COLUMN = "tx_count_5min"


def base_features(tx: DataFrame, p: ScoringParams) -> DataFrame:
    """Adds ``hour`` (0-23), ``is_foreign`` (0/1) and ``amount_log``."""
    return tx.withColumns({
        "hour": hour_of_day("ts"),
        "is_foreign": foreign_flag("country", p.home_country),
        "amount_log": log_amount("amount"),
    })


def trailing_count(
    df: DataFrame,
    window_micros: int,
    bucket_factor: int = 4,
    key: str = "customer_id",
    ts: str = "ts",
    out: str = COUNT_COLUMN,
) -> DataFrame:
    """Rows of the same key with event time in ``[ts - window, ts]``.

    The current row and rows at the same instant are counted (a RANGE frame
    is inclusive of peers). Result is INT.

    Skew: a plain ``Window.partitionBy(key)`` would sort one key's whole
    history in one task. Instead time is cut into buckets ``B`` =
    ``bucket_factor`` windows long and the window is partitioned by
    ``(key, bucket)``. A row's frame reaches back at most one window, so only
    rows in the last window of a bucket are needed by the next bucket; those
    (``1 / bucket_factor`` of the rows, key and time only) are copied forward
    and the copies are counted but not emitted. A hot key is thus spread over
    as many tasks as it has buckets. One scan and one exchange, for short windows;
    a bucket of one key grows with the window, which ``trailing_count_grains``
    avoids and scoring therefore uses.
    """
    if bucket_factor < 1:
        raise ValueError("bucket_factor must be >= 1")
    w = int(window_micros)
    b = w * int(bucket_factor)
    columns = df.columns
    payload = [c for c in columns if c != key]
    us = epoch_micros(ts)
    off = F.pmod(us, F.lit(b))
    home = F.expr(f"(_us - _off) div {b}")
    # one scan: a row lands in its own bucket and, when it lies in the last
    # window of that bucket, also in the next one (payload nulled there)
    buckets = F.when(F.col("_off") >= F.lit(b - w), F.array(home, home + 1)).otherwise(F.array(home))
    both = (
        df.select(*columns, us.alias("_us"), off.alias("_off"))
        .select(key, *payload, "_us", F.posexplode(buckets).alias("_carried", "_bucket"))
        .select(
            key,
            *[F.when(F.col("_carried") == 0, F.col(c)).alias(c) for c in payload],
            "_us", "_bucket", "_carried",
        )
    )
    frame = Window.partitionBy(key, "_bucket").orderBy("_us").rangeBetween(-w, 0)
    return (
        both.withColumn(out, F.count(F.lit(1)).over(frame).cast("int"))
        .filter(F.col("_carried") == 0)
        .select(*columns, out)
    )


def trailing_count_grains(
    df: DataFrame,
    window_micros: int,
    grain_micros: int,
    key: str = "customer_id",
    ts: str = "ts",
    out: str = COUNT_COLUMN,
) -> DataFrame:
    """``trailing_count`` with groups that don't grow with the window.

    Every row enters at its time (+1) and leaves
    just after ``ts + window`` (-1), so a count is the key's running sum of
    both. That sum is split at grains of ``grain_micros``: within a grain it is
    a window partitioned by ``(key, grain)``, and what earlier grains add up to
    comes from the grains' totals, which are aggregated map-side and number no
    more than the calendar has grains. They are kept per grain of entry: rows of one
    grain leave in one of two adjoining grains, so a total holds the rows and how many
    leave in the later one, and is turned into moves after the aggregation: half the
    groups in a task's memory. A task's group is one grain of one key,
    whatever the window's length. The price is a second pass over key and time
    and a copy of each row (key and time only) in the shuffle.
    """
    w = int(window_micros)
    g = int(grain_micros)
    if g < 1:
        raise ValueError("grain_micros must be >= 1")
    columns = df.columns
    payload = [c for c in columns if c != key]
    enter = F.struct(F.col("_us").alias("at"), F.lit(1).alias("by"))
    leave = F.struct((F.col("_us") + F.lit(w + 1)).alias("at"), F.lit(-1).alias("by"))
    # rows without event time are counted among themselves and never leave
    moves = F.when(F.col("_us").isNull(), F.array(enter)).otherwise(F.array(enter, leave))
    grain_of = lambda at: F.expr(f"({at} - pmod({at}, {g}L)) div {g}L")

    own = [F.when(F.col("_by") > 0, F.col(c)).alias(c) for c in payload]
    timed = df.select(*columns, epoch_micros(ts).alias("_us"))
    both = timed.select(key, *payload, F.inline(moves).alias("_at", "_by")).select(key, *own, "_at", "_by", grain_of("_at").alias("_grain"))
    frame = Window.partitionBy(key, "_grain").orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    within = both.withColumn("_in", F.sum("_by").over(frame)).filter(F.col("_by") > 0)

    # a null time has no earlier grains: its totals are left out
    entered = timed.filter("_us is not null").select(key, grain_of("_us").alias("_g"), grain_of(f"(_us + {w + 1}L)").alias("_left"))
    # the first grain that a row of ``_g`` may leave in; the others leave in the next, later by 1
    first = grain_of(f"(_g * {g}L + {w + 1}L)")
    entered = entered.select(key, "_g", (F.col("_left") - first).alias("_by"))
    totals = entered.groupBy(key, "_g").agg(F.count(F.lit(1)).alias("_n"), F.sum("_by").alias("_late"))
    nets = F.array(*[F.struct(at.alias("at"), net.alias("net"), F.lit(mine).alias("mine")) for at, net, mine in (
        (F.col("_g"), F.col("_n"), True), (first, F.col("_late") - F.col("_n"), False), (first + 1, -F.col("_late"), False))])
    net = totals.select(F.col(key).alias("_k"), F.inline(nets).alias("_g", "_net", "_mine")).filter("_net <> 0")
    # grains of a key may repeat here: a range frame leaves out all of the own one
    earlier = Window.partitionBy("_k").orderBy("_g").rangeBetween(Window.unboundedPreceding, -1)
    before = net.withColumn("_before", F.coalesce(F.sum("_net").over(earlier), F.lit(0))).filter("_mine").drop("_net", "_mine")
    same = F.col(key).eqNullSafe(F.col("_k")) & (F.col("_grain") == F.col("_g"))
    count = F.col("_in") + F.coalesce("_before", F.lit(0))
    return within.join(before, same, "left").withColumn(out, count.cast("int")).select(*columns, out)


#: Join keys that one group's rows are dealt over where its statistics are joined back.
GROUP_SALTS = 32


def join_group_stats(df: DataFrame, stats: DataFrame, key: str, salts: int = GROUP_SALTS) -> DataFrame:
    """``df`` left-joined to ``stats``, which has one row per ``key``.

    The statistics side ends in an aggregate, so AQE's skew rule does not
    apply to this join and a hot key's rows would be one task's. Each row
    therefore joins on (key, a hash of the row modulo ``salts``) and each
    statistics row is copied ``salts`` times: the same plan at every size.
    """
    copies = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
    return salted.join(copies, on=[key, "_salt"], how="left").drop("_salt")


def finite(c: str) -> F.Column:
    """The value, NULL where it is NaN or infinite."""
    return F.when(~F.isnan(c) & (F.abs(F.col(c)) != F.lit(float("inf"))), F.col(c))


def batch_customer_count(df: DataFrame, key: str = "customer_id", out: str = "batch_tx_count") -> DataFrame:
    """Rows per key within the frame (the micro-batch proxy), joined back.

    The aggregation combines map-side, so a hot key costs one partial row
    per map task; the left join keeps every row (a NULL key gets NULL) and
    deals a hot key's rows over salted join keys.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return join_group_stats(df, counts, key)


def amount_zscore(df: DataFrame, amount: str = "amount", out: str = "amount_zscore") -> DataFrame:
    """(amount - mean) / sample std over the whole frame.

    Mean and std come from one scalar subquery: a partial aggregate per
    task, one row per task to the final merge, and the two numbers
    substituted into the projection. No unpartitioned window (which would
    move every row to one task) and no join. n = 1 or std = 0 → NULL.
    Amounts that are no finite number are left out of the statistics and get
    NULL.
    """
    x = finite(amount)
    stats = df.select(F.struct(F.avg(x).alias("mu"), F.stddev_samp(x).alias("sd"))).scalar()
    # bound to one column so the plan holds a single subquery
    return (
        df.withColumn("_stats", stats)
        .withColumn(out, F.try_divide(x - F.col("_stats.mu"), F.nullif(F.col("_stats.sd"), F.lit(0.0))))
        .drop("_stats")
    )


def group_zscore(df: DataFrame, key: str = "customer_id", amount: str = "amount",
                 out: str = "customer_zscore") -> DataFrame:
    """z-score of ``amount`` within each key.

    Mean and std per key come from a map-side-combined aggregation (a hot
    key costs one partial row per task), then join back on salted keys (see
    ``join_group_stats``). Amounts that are no finite number are left out of
    the statistics and get NULL.
    """
    x = finite(amount)
    stats = df.groupBy(key).agg(F.avg(x).alias("_mu"), F.stddev_samp(x).alias("_sd"))
    return (
        join_group_stats(df, stats, key)
        .withColumn(out, F.try_divide(x - F.col("_mu"), F.nullif(F.col("_sd"), F.lit(0.0))))
        .drop("_mu", "_sd")
    )


def features(tx: DataFrame, p: ScoringParams) -> DataFrame:
    """Base features plus the trailing per-customer count."""
    return counted(base_features(tx, p), p)


def counted(df: DataFrame, p: ScoringParams) -> DataFrame:
    """The trailing count, split at the parameters' grains whatever the data's size."""
    return trailing_count_grains(df, p.window_micros, p.grain_micros)
