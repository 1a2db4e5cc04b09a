"""Quality rules: document statistics, base rules and gradient-boosted trees.

The trees are fitted in numpy on a bounded sample of labelled documents, with
monotonic constraints on the features whose direction is known, and flattened
into node arrays that score a whole Arrow batch at once.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import SPACES, hash_sample, map_batches, read, texts_of, whole_text

#: Labelled documents that the trees are fitted on, at most (in expectation).
TRAIN_ROWS = 12_000
#: A document passes the trees from this probability of good quality on.
KEEP_FROM = 0.5
#: Base rules: fewest words, largest share of words in repeated 3-word windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Feature -> direction that quality may move in as it grows (0: free).
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "longest_word": -1,
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "distinct_share": 0,
    "upper_share": -1,
    "digit_share": -1,
    "bang_share": -1,
    "full_stop_share": 0,
    "comma_share": 0,
    "line_words": 0,
    "short_line_share": -1,
}

_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The base counts and the features of one whole text."""
    raw = text.encode()
    words = raw.split()  # bytes are parted at ASCII white space only
    n = len(words)
    word_chars = len(text) - sum(map(text.count, SPACES))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    n_dup = len(lines) - len(set(lines))
    repeat = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        many = {w for w, c in Counter(windows).items() if c > 1}
        end = 0
        for i, w in enumerate(windows):
            if w in many:
                repeat += i + 3 - max(i, end)
                end = i + 3
    counts = [n, word_chars, n_symbols, n_dup, repeat]
    size, per_word, per_line = max(1, len(raw)), max(1, n), max(1, len(lines))
    features = [
        np.log1p(n),
        word_chars / per_word,
        min(200, max(map(len, words), default=0)),
        n_symbols / max(1, word_chars),
        n_dup / per_line,
        repeat / per_word,
        len(set(words)) / per_word,
        (len(raw) - len(raw.translate(None, _UPPER))) / size,
        (len(raw) - len(raw.translate(None, _DIGITS))) / size,
        (raw.count(b"!") + raw.count(b"?")) / per_word,
        raw.count(b".") / per_word,
        raw.count(b",") / per_word,
        min(500.0, n / per_line),
        sum(len(x) < 20 for x in lines) / per_line,
    ]
    return counts, features


@dataclass
class Trees:
    """Node arrays of all trees, (trees, nodes): a leaf has feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, left, right, value in zip(self.feature, self.threshold, self.left, self.right, self.value):
            at = np.zeros(len(x), int)
            while True:
                f = feature[at]
                if (f < 0).all():
                    break
                step = np.where(x[rows, np.maximum(f, 0)] <= threshold[at], left[at], right[at])
                at = np.where(f < 0, at, step)
            total += value[at]
        return 1 / (1 + np.exp(-total))


def fit_trees(
    x: np.ndarray, y: np.ndarray, direction: list[int], trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least: float = 5.0
) -> Trees:
    """Newton boosting of the log loss on binned features.

    A split on a constrained feature is taken only if its two leaf values stand
    in the required order, and the children inherit their midpoint as a bound,
    so every tree, and so the sum, is monotonic. Without both classes the trees
    are empty and the score is the classes' share.
    """
    nodes = 2 ** (depth + 1) - 1
    p = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(p / (1 - p)))
    if len(np.unique(y)) < 2:
        trees = 0
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T] if trees else []
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], 1) if trees else np.zeros((0, 0), int)
    out = Trees(*(np.full((trees, nodes), v, t) for v, t in ((-1, int), (0, float), (0, int), (0, int), (0, float))), base)
    score = np.full(len(y), base)
    for t in range(trees):
        prob = 1 / (1 + np.exp(-score))
        g, h = prob - y, prob * (1 - prob)
        todo, free = [(0, np.arange(len(y)), -np.inf, np.inf, 0)], 1
        while todo:
            node, rows, low, high, level = todo.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            value = float(np.clip(-gs / (hs + ridge), low, high))
            best = None
            for f in range(x.shape[1]) if level < depth else ():
                if not len(edges[f]):
                    continue
                b, k = binned[rows, f], len(edges[f]) + 1
                gl = np.cumsum(np.bincount(b, g[rows], k))[:-1]
                hl = np.cumsum(np.bincount(b, h[rows], k))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=k))[:-1]
                vl = np.clip(-gl / (hl + ridge), low, high)
                vr = np.clip(-(gs - gl) / (hs - hl + ridge), low, high)
                ok = (nl >= least) & (len(rows) - nl >= least) & (direction[f] * (vr - vl) >= 0)
                gain = np.where(ok, gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge), 0)
                i = int(gain.argmax())
                if gain[i] > 1e-6 and (best is None or gain[i] > best[0]):
                    best = (gain[i], f, i, vl[i], vr[i])
            if best is None:
                out.value[t, node] = rate * value
                score[rows] += rate * value
                continue
            _, f, i, vl, vr = best
            goes, mid = binned[rows, f] <= i, (vl + vr) / 2
            lo_l, hi_l = (low, mid) if direction[f] > 0 else (mid, high) if direction[f] < 0 else (low, high)
            lo_r, hi_r = (mid, high) if direction[f] > 0 else (low, mid) if direction[f] < 0 else (low, high)
            out.feature[t, node], out.threshold[t, node] = f, edges[f][i]
            out.left[t, node], out.right[t, node] = free, free + 1
            todo += [(free, rows[goes], lo_l, hi_l, level + 1), (free + 1, rows[~goes], lo_r, hi_r, level + 1)]
            free += 2
    return out


def with_statistics(docs: DataFrame, carry: list[str], text: str, trees: Trees | None) -> DataFrame:
    """``carry`` (renamed c0, c1, ...), the base counts, and either the score or the features."""
    inner = [f"c{i}" for i in range(len(carry))]
    frame = docs.select(*[F.col(c).alias(i) for c, i in zip(carry, inner)], whole_text(text).alias("t"))
    new = ", ".join(f"{c} bigint" for c in COUNTS) + (", score double" if trees else ", features array<double>")

    def make():
        def batch(b):
            both = [statistics(t) for t in texts_of(b, "t")]
            counts = [pa.array([c[k] for c, _ in both], pa.int64()) for k in range(len(COUNTS))]
            x = np.array([f for _, f in both], float).reshape(len(both), len(FEATURES))
            last = pa.array(trees.probability(x)) if trees else pa.array(list(x), pa.list_(pa.float64()))
            return [*counts, last]

        return batch

    return map_batches(frame, inner, new, make)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Trees for ``labels.quality``, from about ``rows`` labelled documents.

    Labels and ids that are null are left out; a document with several labels
    counts as good only if all say so; of several documents with one id the least
    text counts. The sampled ids, at most ``rows`` of
    them, are what is broadcast, and their features what the driver collects.
    """
    marked = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    some = hash_sample(marked, "doc_id", rows).select(F.col("doc_id").alias("id"), F.col("quality").alias("y"))
    picked = docs.select(F.col("doc_id").alias("id"), F.col("text")).join(F.broadcast(some), "id")
    picked = picked.groupBy("id", "y").agg(F.min("text").alias("text"))
    got = with_statistics(picked, ["id", "y"], "text", None).select("c0", "c1", "features").toPandas().sort_values(["c0", "c1"])
    x = np.array(got.features.tolist(), float).reshape(len(got), len(FEATURES))
    return fit_trees(x, (got.c1.to_numpy(float) > 0).astype(float), list(FEATURES.values()))


def judge(docs: DataFrame, trees: Trees, carry: list[str], text: str = "text", prefix: str = "") -> DataFrame:
    """``carry`` with the base counts, ``base_failed``, ``score`` and ``kept`` of each row.

    A null or empty text has no words, so the base rules reject it. Each row is
    judged by its own text: repeated rows are judged alike, an empty table gives
    an empty one, very long texts are read whole. Only ``carry`` and the text are
    read; ``prefix`` sets the new columns apart from carried ones of that name.
    """
    out = with_statistics(docs, carry, text, trees)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    new = {c: F.col(c) for c in COUNTS} | {"base_failed": failed, "score": F.col("score"), "kept": ~failed & (F.col("score") >= KEEP_FROM)}
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], *[v.alias(prefix + k) for k, v in new.items()])


def op6_quality(spark, sf_dir):
    """Contract query: statistics and verdict of every document."""
    docs = read(spark, sf_dir, "documents")
    trees = fit(docs, read(spark, sf_dir, "labels"))
    return judge(docs, trees, ["doc_id"])


def stage_quality(spark, docs, sf_dir):
    """Pipeline stage: rows that the rules reject go."""
    trees = fit(docs, read(spark, sf_dir, "labels"))
    out = judge(docs, trees, docs.columns, prefix="__q_").filter("__q_kept")
    return out.select(*docs.columns)
