"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; documents drawn from the whole
learning part, whatever their label, are the unlabelled rest. A logistic model on
the presence of words is fitted in numpy to the risk that is corrected for the
class prior and kept non-negative, and scores every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import discard, fold_mod, hash_sample, map_batches, read, ship, texts_of, whole_text, written
from txrisk.llm.decontam import words_of

#: Documents that the model is fitted on, at most (in expectation).
POSITIVE_ROWS, UNLABELLED_ROWS = 3_000, 9_000
#: Words that the model weighs, at most: the ones most typical of the positives.
WORDS = 400
#: A word counts if this many positives hold it.
LEAST_POSITIVES = 5
#: ... and its share among them is so many standard errors and times above that among the unlabelled.
LEAST_Z, LEAST_RATIO = 5, 3
TOXIC_FROM = 0.7


def word_hashes(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct words, and of the stems of the longer ones.

    A stem is a word's first four, five and six characters; inflected forms share it.
    """
    words = set(words_of(text))
    stems = {w.decode("utf-8", "replace") for w in words if len(w) > 4}
    parts = words | {b"5 " + w[:5].encode() for w in stems} | {b"6 " + w[:6].encode() for w in stems if len(w) > 5} | {b"4 " + w[:4].encode() for w in stems}
    return np.sort(np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts)).view(np.int64))


@dataclass
class Model:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-(self.bias + self.weights[places(self.words, text)].sum()))))


def typical_words(words: np.ndarray, held: np.ndarray, seen: np.ndarray, n_positive: int, n_unlabelled: int) -> np.ndarray:
    """Hashes of the words whose share among positives most exceeds that among the
    unlabelled. ``held`` and ``seen``: documents of either kind with the word."""
    p, u = held / max(1, n_positive), seen / max(1, n_unlabelled)
    mean = (held + seen) / (n_positive + n_unlabelled)
    z = (p - u) / np.sqrt(mean * (1 - mean) * (1 / max(1, n_positive) + 1 / max(1, n_unlabelled)) + 1e-12)
    typical = np.flatnonzero((z > LEAST_Z) & (p >= LEAST_RATIO * u))
    return np.sort(words[typical[np.lexsort((words[typical], -z[typical]))[:WORDS]]])


def places(words: np.ndarray, text: str) -> np.ndarray:
    """Places, among the sorted hashes ``words``, of those that the text has."""
    if not len(words):
        return np.zeros(0, np.int64)
    h = word_hashes(text)
    at = np.minimum(np.searchsorted(words, h), len(words) - 1)
    return at[words[at] == h]


def fit_pu(xp: np.ndarray, xu: np.ndarray, prior: float, steps: int = 300, rate: float = 0.05, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise  prior * E_p[l(+)] + max(0, E_u[l(-)] - prior * E_p[l(-)]).

    ``l`` is the logistic loss. Where the second term, the risk on negatives,
    would be below nought the step goes up its gradient instead, which undoes
    the overfitting that a negative risk is the sign of.
    """
    w, b = np.zeros(xp.shape[1], np.float32), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        zp, zu = xp @ w + b, xu @ w + b
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        positive = prior * (sp - 1) / len(zp)  # of the first term, by zp
        from_p, from_u = -prior * sp / len(zp), su / len(zu)  # of the second term
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        sign, first = (1.0, 1.0) if negative_risk >= 0 else (-1.0, 0.0)
        gp, gu = first * positive + sign * from_p, sign * from_u
        g = np.append(xp.T @ gp + xu.T @ gu + ridge * w, gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = (w - step[:-1]).astype(np.float32), b - step[-1]
    return w, b


def fit(docs: DataFrame, labels: DataFrame, learn, positive_rows: int = POSITIVE_ROWS, unlabelled_rows: int = UNLABELLED_ROWS) -> Model:
    """A model from the documents for which the condition ``learn`` (on doc_id) holds.

    ``labels.toxic``: 1 confirms; a document is confirmed if any of its labels
    does. The prior is the share confirmed among the labelled documents of the
    learning part. Without a positive the score is nought everywhere.
    """
    marked = labels.filter("doc_id is not null and toxic is not null").filter(learn).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total, toxic = marked.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") > 0).cast("int")), F.lit(0))).first()
    if not toxic:
        return Model(np.zeros(0, np.int64), np.zeros(0), -np.inf)
    prior = float(np.clip(toxic / total, 1e-4, 0.9))
    positives = hash_sample(marked.filter("toxic > 0"), "doc_id", positive_rows).select(F.col("doc_id").alias("id"))
    texts = docs.select("doc_id", whole_text().alias("t")).filter(learn)
    # the sampled ids, a bounded number, are broadcast
    p = texts.join(F.broadcast(positives), F.col("doc_id") == F.col("id"), "left_semi").groupBy("doc_id").agg(F.min("t").alias("t")).select(F.lit(1).alias("p"), "t")
    u = hash_sample(texts, "doc_id", unlabelled_rows).select(F.lit(0).alias("p"), "t")
    sample, at = written(p.unionByName(u), "toxicity-sample")
    try:
        return fit_on(sample, prior)
    finally:
        discard(docs.sparkSession, at)


def fit_on(sample: DataFrame, prior: float) -> Model:
    """A model from the rows (p, t) of the sample: 1 and a positive's text, or 0 and an unlabelled one's.

    Word counts are added up in the cluster. The driver gets the words that
    enough positives hold, and the weighed words of each sampled document.
    """
    ship(sample.sparkSession)

    def count(batches):
        for b in batches:
            rows = [word_hashes(t) for t in texts_of(b, "t")]
            flag = np.repeat(np.array(texts_of(b, "p"), np.int64), [len(r) for r in rows])
            words, at = np.unique(np.concatenate([np.zeros(0, np.int64), *rows]), return_inverse=True)
            held = np.bincount(at, flag, len(words)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(held), pa.array(np.bincount(at, minlength=len(words)) - held)], names=["w", "p", "u"])

    sizes = {r.p: r.n for r in sample.groupBy("p").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1):
        return Model(np.zeros(0, np.int64), np.zeros(0), -np.inf)
    counts = sample.mapInArrow(count, "w bigint, p bigint, u bigint").groupBy("w").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    got = counts.filter(F.col("p") >= LEAST_POSITIVES).toPandas().sort_values("w")
    words = typical_words(got.w.to_numpy(np.int64), got.p.to_numpy(float), got.u.to_numpy(float), sizes[1], sizes.get(0, 0))

    def make():
        return lambda b: [pa.array([places(words, t) for t in texts_of(b, "t")], pa.list_(pa.int64()))]

    rows = map_batches(sample, ["p"], "at array<bigint>", make).toPandas()
    x = np.zeros((len(rows), len(words)), np.float32)
    for i, at in enumerate(rows["at"]):
        x[i, at] = 1
    # the order of the sums doesn't depend on that of the rows
    order = np.lexsort((*x.T[::-1], rows.p)) if len(words) else np.arange(len(rows))
    x, positive = x[order], rows.p.to_numpy()[order] == 1
    if not (~positive).any():
        return Model(np.zeros(0, np.int64), np.zeros(0), -np.inf)
    weights, bias = fit_pu(x[positive], x[~positive], prior)
    return Model(words, weights, bias)


def score(docs: DataFrame, model: Model, carry: list[str], text: str = "text") -> DataFrame:
    """``carry`` with ``score`` (0 to 1) of each row.

    A null or empty text has no words and gets the score of the bias alone. Each
    row is scored by its own whole text: repeated rows alike, an empty table
    gives an empty one. Only ``carry`` and the text are read.
    """
    inner = [f"c{i}" for i in range(len(carry))]
    frame = docs.select(*[F.col(c).alias(i) for c, i in zip(carry, inner)], whole_text(text).alias("t"))
    out = map_batches(frame, inner, "score double", lambda: lambda b: [pa.array([model.score(t) for t in texts_of(b, "t")], pa.float64())])
    return out.select(*[F.col(i).alias(c) for i, c in zip(inner, carry)], "score")


def op8_toxicity(spark, sf_dir):
    """Contract query: score of every document; rows of remainder 1 are held out of fitting."""
    docs = read(spark, sf_dir, "documents")
    held_out = fold_mod("doc_id", 3) == 1
    model = fit(docs, read(spark, sf_dir, "labels"), ~held_out)
    return score(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
