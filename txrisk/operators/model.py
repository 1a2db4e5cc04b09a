"""Labels, training and scoring with a Spark ML pipeline.

Stages (as the original trainer): one StringIndexer per categorical column
(frequency order, unseen → extra index), one-hot encoding with the last
slot dropped, a VectorAssembler over five numeric features and the three
one-hot vectors, and a logistic regression (maxIter 50, L2 0.01).

Fitting is distributed by MLlib (one aggregation per indexer, then one
tree-aggregated gradient per iteration). The input is checkpointed to the
shared checkpoint folder first, so an executor lost mid-fit recomputes from
the checkpoint rather than from the raw tables.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.columns import is_flagged, round_to, rule_label
from txrisk.operators.features import COUNT_COLUMN, join_group_stats
from txrisk.operators.scoring import SCORE_COLUMN, probability_of_class1
from txrisk.params import ModelParams, ScoringParams
from txrisk.session import materialize

TRAINING_COLUMNS = [
    "transaction_id", "customer_id", "ts", "amount", "country", "category", "merchant",
    "hour", "is_foreign", "amount_log", COUNT_COLUMN, "label",
]


def with_label(features_df: DataFrame, p: ScoringParams) -> DataFrame:
    """Adds the rule label (0/1) to a frame that has the features."""
    return features_df.withColumn("label", rule_label("amount", "country", COUNT_COLUMN, "category", p))


def hash_split(df: DataFrame, fraction: float, seed: int, key: str = "transaction_id") -> tuple[DataFrame, DataFrame]:
    """Deterministic split on a hash of the key.

    Unlike ``randomSplit``, membership depends only on the key, so it is
    stable under repartitioning, retries and re-reads; md5 is the same in
    every engine.
    """
    low = in_first_part(fraction, seed, key)
    return df.filter(low), df.filter(~low)


def in_first_part(fraction: float, seed: int, key: str = "transaction_id") -> F.Column:
    """Whether the first eight hex digits of md5(seed:key), as a share of their
    range, lie below ``fraction``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key)).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") < F.lit(int(fraction * 2**32))


def build_pipeline(mp: ModelParams) -> Pipeline:
    slots = {c: (index_column(c), f"{c}_slots") for c in mp.categorical}
    indexer = StringIndexer(handleInvalid="keep").setInputCols(list(slots)).setOutputCols([i for i, _ in slots.values()])
    encoder = OneHotEncoder().setInputCols([i for i, _ in slots.values()]).setOutputCols([s for _, s in slots.values()])
    vector = VectorAssembler(outputCol="features").setInputCols([*mp.numeric, *(s for _, s in slots.values())])
    return Pipeline(stages=[indexer, encoder, vector, LogisticRegression(maxIter=mp.max_iter, regParam=mp.reg_param)])


def index_column(c: str) -> str:
    return f"{c}_index"


def string_index(df: DataFrame, mp: ModelParams) -> DataFrame:
    """(feature, value, n, index) of the fitted indexer, for every value of ``df``:
    most frequent first, equally frequent ones by value."""
    fitted = build_pipeline(mp).getStages()[0].fit(df.select(*mp.categorical))
    indexed = fitted.transform(df.select(*mp.categorical))
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"), F.col(index_column(c)).cast("int").alias("index")) for c in mp.categorical])
    return indexed.select(F.inline(cells)).groupBy("feature", "value", "index").agg(F.count(F.lit(1)).alias("n"))


def value_index(df: DataFrame, mp: ModelParams) -> DataFrame:
    """``string_index`` without a list of labels on the driver, for columns with any
    number of values: (feature, value, n, index), most frequent first, ties by value.

    Counts combine map-side. They are put in order by a range partitioning over all
    features, a value's index is its place in its partition after what the partitions
    before hold of its feature, and only those totals, a row for each partition and
    feature, meet in one window. The ordered counts are written before they are
    numbered, so a lost executor doesn't number them anew.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in mp.categorical])
    counts = df.select(F.inline(cells)).filter("value is not null").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    order = ["feature", F.col("n").desc(), "value"]
    place = F.monotonically_increasing_id()
    ordered = counts.repartitionByRange(*order).sortWithinPartitions(*order).select("feature", "value", "n", place.alias("at"))
    ordered = materialize(ordered.withColumn("part", F.shiftright("at", 33)))
    held = ordered.groupBy("feature", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("here"))
    before = F.sum("here").over(Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = held.select("feature", "part", "first", F.coalesce(before, F.lit(0)).alias("start"))
    return ordered.join(starts, ["feature", "part"]).select("feature", "value", "n", (F.col("at") - F.col("first") + F.col("start")).cast("int").alias("index"))


def one_hot_rows(df: DataFrame, mp: ModelParams) -> DataFrame:
    """(feature, slot, n): how many rows of ``df`` set each slot of the fitted
    one-hot vectors; a row whose value is unseen or NULL sets none (slot -1)."""
    from pyspark.ml.functions import vector_to_array

    indexer, encoder = build_pipeline(mp).getStages()[:2]
    data = df.select(*mp.categorical)
    indexed = indexer.fit(data).transform(data)
    coded = encoder.fit(indexed).transform(indexed)
    slot = lambda c: F.array_position(vector_to_array(F.col(f"{c}_slots")), F.lit(1.0)).cast("int") - 1
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), slot(c).alias("slot")) for c in mp.categorical])
    return coded.select(F.inline(cells)).groupBy("feature", "slot").agg(F.count(F.lit(1)).alias("n"))


def fit(train: DataFrame, mp: ModelParams, checkpoint: bool = True) -> PipelineModel:
    """Fit the pipeline. ``checkpoint`` materialises the training frame first
    (a reliable checkpoint into ``spark.checkpoint.dir``; see
    ``session.materialize``); pass False when the input is already
    materialised."""
    data = train.select(*list(mp.numeric), *list(mp.categorical), "label")
    if checkpoint:
        data = materialize(data)
    return build_pipeline(mp).fit(data)


def score_model(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``risk_score`` = P(class 1); the pipeline's helper columns are dropped."""
    out = probability_of_class1(model.transform(df))
    keep = df.columns + [SCORE_COLUMN]
    return out.select(*keep)


def evaluate(scored: DataFrame, cut: float = 0.5) -> DataFrame:
    """One row: n, positives, predicted ones at ``cut``, and accuracy from the
    confusion counts. A score that is NaN or NULL predicts nothing: it is
    neither a predicted one nor a hit."""
    positive, predicted = F.col("label") == 1, is_flagged(SCORE_COLUMN, cut)
    below = F.col(SCORE_COLUMN) < cut
    counts = scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(positive).alias("n_positive"),
        F.count_if(predicted).alias("n_predicted"),
        F.count_if(predicted & positive).alias("_tp"),
        F.count_if(below & (F.col("label") == 0)).alias("_tn"),
    )
    return counts.select("n", "n_positive", "n_predicted", round_to(F.try_divide(F.col("_tp") + F.col("_tn"), "n"), 6).alias("accuracy"))


def calibration(scored: DataFrame) -> DataFrame:
    """One row: n and the mean score. With an unpenalised intercept a fitted
    model's mean score over its training rows is their share of positives."""
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(SCORE_COLUMN).alias("mean_score"))


def optimality(train: DataFrame, coefs: dict, mp: ModelParams, tolerance: float) -> DataFrame:
    """A certificate of the fit, one row per feature: (feature, value, sigma,
    label_moment, optimal).

    A logistic regression is at its optimum exactly where, for every feature x of
    standard deviation sigma and weight w, the mean of (p - y) x / sigma plus the
    penalty's derivative, ``reg_param`` w sigma, is zero (for the intercept, the mean
    of p - y). ``optimal`` says that it is within ``tolerance``; ``label_moment`` is the
    mean of y x / sigma, what the model's own moment and penalty have to add up to.

    ``train`` has the features and ``label``. Rows are taken apart into (feature, value,
    x) cells, which are added up map-side, one group per feature and value; what no
    row has is zero. The weights are joined as a table.
    """
    p = coefficient_score(coefs)
    numeric = [F.struct(F.lit(c).alias("feature"), F.lit("").alias("value"), F.col(c).cast("double").alias("x")) for c in mp.numeric]
    ones = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"), F.lit(1.0).alias("x")) for c in mp.categorical]
    intercept = F.struct(F.lit("intercept").alias("feature"), F.lit("").alias("value"), F.lit(1.0).alias("x"))
    y = F.col("label").cast("double")
    cells = train.select(y.alias("y"), p.alias("p"), F.inline(F.array(intercept, *numeric, *ones))).filter("value is not null")
    x, n = F.col("x"), F.col("n")
    sums = cells.groupBy("feature", "value").agg(
        F.sum("x").alias("sx"), F.sum(x * x).alias("sxx"), F.sum(x * F.col("y")).alias("sxy"), F.sum(x * F.col("p")).alias("sxp"))
    size = train.select(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    sigma = F.when(F.col("feature") == "intercept", 1.0).otherwise(F.sqrt((F.col("sxx") - F.col("sx") * F.col("sx") / n) / (n - 1)))
    weights = train.sparkSession.createDataFrame(coefficient_rows(coefs), "feature string, value string, weight double")
    known = sums.join(weights, ["feature", "value"], "left").withColumn("n", size).withColumn("sigma", sigma)
    penalty = F.when(F.col("feature") == "intercept", 0.0).otherwise(F.lit(mp.reg_param) * F.col("weight") * F.col("sigma"))
    # a constant feature has no say
    per = lambda c: F.coalesce(F.try_divide(F.col(c) / n, F.nullif(F.col("sigma"), F.lit(0.0))), F.lit(0.0))
    off = per("sxp") - per("sxy") + F.coalesce(penalty, F.lit(float("inf")))
    return known.select("feature", "value", round_to("sigma", 6).alias("sigma"), round_to(per("sxy"), 6).alias("label_moment"),
                        (F.abs(off) <= F.lit(tolerance)).alias("optimal"))


#: Parts of the range of scores that ``exact_auc`` ranks on their own.
SCORE_PARTS = 256


def exact_auc(scored: DataFrame) -> DataFrame:
    """One row: n, n_positive and the area under the ROC curve (NULL without both
    labels), by rank sums; tied scores count half. Rows whose score is NULL or NaN or
    whose label is NULL are left out.

    Counts per score are made map-side. How many negatives score below is a running
    sum, which would be one task over all scores: the scores are cut at quantiles into
    ``SCORE_PARTS`` parts, summed within a part by a window of that part, and the parts'
    totals (as many rows as parts) by another. Sums are exact integers.
    """
    fine = scored.select(F.col(SCORE_COLUMN).cast("double").alias("s"), (F.col("label") == 1).alias("one")).filter("s is not null and not isnan(s) and one is not null")
    per = fine.groupBy("s").agg(F.count_if("one").alias("pos"), F.count_if(~F.col("one")).alias("neg"))
    cuts = per.agg(F.percentile_approx("s", [i / SCORE_PARTS for i in range(1, SCORE_PARTS)], 10_000)).first()[0] or []
    splits = [float("-inf"), *sorted({0.5, *cuts}), float("inf")]
    parts = Bucketizer(splits=splits, inputCol="s", outputCol="part").transform(per)
    below = Window.partitionBy("part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    inside = parts.withColumn("lower", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    per_part = inside.groupBy("part").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum(whole("pos") * (2 * F.col("lower") + F.col("neg"))).alias("twice"))
    totals = per_part.withColumn("lower", F.coalesce(F.sum("neg").over(before), F.lit(0)))
    one = totals.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("neg"),
                     F.sum(F.col("twice") + 2 * whole("pos") * F.col("lower")).alias("twice"))
    area = F.try_divide(F.col("twice").cast("double"), 2.0 * F.col("pos").cast("double") * F.col("neg").cast("double"))
    return one.select((F.col("pos") + F.col("neg")).alias("n"), F.col("pos").alias("n_positive"), round_to(area, 6).alias("auc"))


def auc(scored: DataFrame) -> float:
    """Area under ROC (MLlib evaluator, distributed)."""
    ev = BinaryClassificationEvaluator(rawPredictionCol=SCORE_COLUMN, labelCol="label", metricName="areaUnderROC")
    return ev.evaluate(scored.select(F.col(SCORE_COLUMN).cast("double"), F.col("label").cast("double")))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---------------------------------------------------------------- coefficients

def coefficients(model: PipelineModel, mp: ModelParams) -> dict:
    """Intercept, numeric weights and per-label categorical weights.

    With ``dropLast`` one-hot encoding and ``handleInvalid='keep'``, an
    indexer with k labels emits k+1 indices (the extra one for unseen and
    NULL), the encoder k slots, and the extra index is the dropped one —
    so unseen and NULL values contribute 0 and every known label keeps its
    own weight.
    """
    indexer, _encoder, _assembler, lr = model.stages
    w = lr.coefficients.toArray().tolist()
    numeric = dict(zip(mp.numeric, w[: len(mp.numeric)]))
    pos = len(mp.numeric)
    cats = {}
    for col, labels in zip(mp.categorical, indexer.labelsArray):
        cats[col] = dict(zip(labels, w[pos: pos + len(labels)]))
        pos += len(labels)
    return {"intercept": float(lr.intercept), "numeric": numeric, "categorical": cats}


def coefficient_score(coefs: dict) -> F.Column:
    """The fitted model as one JVM-side expression: sigmoid(b + w·x).

    Categorical weights are a literal map lookup (unseen/NULL → 0).
    """
    z = F.lit(coefs["intercept"])
    for name, wt in coefs["numeric"].items():
        z = z + F.lit(wt) * F.col(name).cast("double")
    for col, table in coefs["categorical"].items():
        if not table:
            continue
        lookup = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])
        z = z + F.coalesce(F.try_element_at(lookup, F.col(col)), F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def table_score(df: DataFrame, weights: DataFrame, mp: ModelParams) -> DataFrame:
    """``df`` with ``risk_score`` by a table of weights (feature, value, weight), for
    columns with any number of values: each column's weights are joined, on salted keys
    (see ``features.join_group_stats``) where they are too many to be broadcast. The
    intercept and the numeric weights, one row each, are the only ones read here. A
    value without weight counts 0."""
    few = {r.feature: r.weight for r in weights.filter(F.col("feature").isin("intercept", *mp.numeric)).collect()}
    out, z = df, F.lit(few.get("intercept", 0.0))
    for name in mp.numeric:
        z = z + F.lit(few.get(name, 0.0)) * F.col(name).cast("double")
    for c in mp.categorical:
        own = weights.filter(F.col("feature") == c).select(F.col("value").alias(c), F.col("weight").alias(f"_w_{c}"))
        out = join_group_stats(out, own, c)
        z = z + F.coalesce(F.col(f"_w_{c}"), F.lit(0.0))
    return out.select(*df.columns, (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias(SCORE_COLUMN))


def coefficient_rows(coefs: dict) -> list[tuple[str, str, float]]:
    """(feature, value, weight) rows of the coefficient table."""
    rows = [("intercept", "", coefs["intercept"])]
    rows += [(k, "", v) for k, v in coefs["numeric"].items()]
    for col, table in coefs["categorical"].items():
        rows += [(col, k, v) for k, v in sorted(table.items())]
    return [(a, b, float(c)) for a, b, c in rows]
