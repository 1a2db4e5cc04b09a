"""Personal data: base patterns, and a skip-chain conditional random field.

The patterns find spans of four kinds. The field labels the words that hold a
digit or ``@``, words that are the name of a pattern's address, and neighbouring
groups of digits that together are a pattern's number or its end (one node): each
has an emission score from its shape, neighbouring words share a chain potential,
and distant words of the same normal form share a skip potential. Loopy message passing spreads the labels of the patterns' spans over
a document, so that a number or name written once with and once without the
parts that the pattern asks for gets one label. Emissions, chain and skip
potentials are fitted to the patterns' own labels on a sample of documents. What no
pattern matches but repeats a pattern's span has no label there: it is left
unobserved, and its share of each label is estimated (EM), so the field does not
learn from its own blind spot that repeats are no personal data.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import hash_sample, map_batches, read, ship, texts_of, whole_text

KINDS = ("email", "ip", "card", "phone")
#: Documents that the potentials are fitted on, at most (in expectation).
TRAIN_DOCS = 20_000
#: Marginal probability from which a word gets its label.
SURE = 0.9
ROUNDS, DAMPING = 12, 0.3
#: Shortest normal form that shares a skip potential.
LEAST_FORM = 6
#: Skip edges taken to agree before any is seen: that two words of a document share so
#: long a form by coincidence is put at less than one in a thousand.
PRIOR_PAIRS = 1000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A pattern that fails at the start of a run of digits fails within it, so runs are tried once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"\S+")
#: A group of digits of a number that blanks part.
_GROUP = re.compile(r"[+(\"'<\[]*[0-9][0-9().+/-]*[.,;:!?\"'>\]]*")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the patterns' matches, sorted.

    Each kind is matched by itself, leftmost and without overlap; a match that
    fails its check is dropped and its characters are not tried again.
    """
    out = []
    end, at = 0, text.find("@")
    while at >= 0:
        low = at
        while low > end and text[low - 1] in _LOCAL:
            low -= 1
        m = _DOMAIN.match(text, at + 1) if low < at else None
        if m:
            end = m.end()
            out.append((low, 0, end))
        else:
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


# -- words, features, neighbours ------------------------------------------------

#: Sizes of the categorical features: digits, characters present, length, shape, neighbours.
SIZES = (10, 128, 8, 256, 4)
OFFSETS = np.concatenate([[0], np.cumsum(SIZES)[:-1]])
LABELS = len(KINDS) + 1  # 0 is no personal data
_RUNS = (re.compile(r"[0-9]+"), re.compile(r"[^\W\d_]+"))


@dataclass
class Words:
    """The nodes of one document: words that hold a digit or ``@`` or repeat a pattern's span."""

    spans: list[tuple[int, int]]
    features: np.ndarray
    labels: np.ndarray  # of the pattern span that touches the word, else 0
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def normal_form(word: str) -> str:
    """Equal for the ways one datum is written: its digits where they lead, else the name before ``@``."""
    digits = "".join(_DIGIT.findall(word))
    letters = sum(c.isalpha() for c in word)
    if len(digits) >= LEAST_FORM and len(digits) > letters:
        return digits
    return word.partition("@")[0].strip(".,;:!?()<>[]\"'").lower()


def forms_of(text: str, base: list[tuple[int, int, int]]) -> tuple[dict[str, int], dict[str, int]]:
    """Names of addresses, and runs of digits of cards and phones, with the number of the first span.

    A run is the whole number or its last digits (a phone without its country's
    code), however they are grouped.
    """
    names: dict[str, int] = {}
    numbers: dict[str, int] = {}
    for k, (a, kind, b) in enumerate(base):
        if KINDS[kind] == "email":
            name = normal_form(text[a:b].partition("@")[0])
            if len(name) >= LEAST_FORM:
                names.setdefault(name, k)
        elif KINDS[kind] != "ip":
            digits = "".join(_DIGIT.findall(text[a:b]))
            for i in range(len(digits) - LEAST_FORM + 1):
                numbers.setdefault(digits[i:], k)
    return names, numbers


def nodes_of(text: str, base: list[tuple[int, int, int]]):
    """(first place, last place, start, end, number of the span repeated or -1) of each node, in order."""
    names, numbers = forms_of(text, base) if base else ({}, {})
    longest = max(map(len, numbers), default=0)
    touched, k = [], 0
    words = [m.span() for m in _WORD.finditer(text)]
    for start, end in words if numbers else ():
        while k < len(base) and base[k][2] <= start:
            k += 1
        touched.append(any(s[0] < end and s[2] > start for s in base[k : k + 4]))
    place = 0
    while place < len(words):
        start, end = words[place]
        w = text[start:end]
        if _DIGIT.search(w):
            best, run = None, ""
            for j in range(place, len(words) if numbers else place):
                g = text[words[j][0] : words[j][1]]
                if touched[j] or not _GROUP.fullmatch(g):
                    break
                run += "".join(_DIGIT.findall(g))
                if run in numbers:
                    best = (j, numbers[run])
                if len(run) >= longest or g[-1] in ".,;:!?\"'>]":
                    break
            last, span = best or (place, -1)
            yield place, last, start, words[last][1], span
            place = last + 1
            continue
        if "@" in w:
            yield place, place, start, end, -1
        elif names and (span := names.get(normal_form(w), -1)) >= 0:
            yield place, place, start, end, span
        place += 1


def words_of(text: str, base: list[tuple[int, int, int]]) -> Words:
    spans, features, labels, chain = [], [], [], []
    k = 0
    before = -2
    repeats, hubs = [], {}
    for first, last, start, end, span in nodes_of(text, base):
        # as in the spans, the sentence's punctuation is no part of a word's shape
        w = "".join(text[start:end].split()).lstrip("\"'<[,;:").rstrip(".,;:!?\"'>]")
        digits = len(_DIGIT.findall(w))
        while k and base[k - 1][2] > start:
            k -= 1
        while k < len(base) and base[k][2] <= start:
            k += 1
        label = next((b[1] + 1 for b in base[k : k + 4] if b[0] < end and b[2] > start), 0)
        for x in range(k, min(k + 4, len(base))):
            if base[x][0] < end and base[x][2] > start and base[x][1] + 1 == label:
                hubs.setdefault(x, len(spans))
        if span >= 0 and not label:
            repeats.append((span, len(spans)))
        flags = sum((c in w) << i for i, c in enumerate("@+(.-")) | any(map(str.isalpha, w)) << 5 | (w.count(".") >= 3) << 6
        shape = _RUNS[1].sub("a", _RUNS[0].sub("9", w))
        size = min(digits, 4) if digits < 5 else 5 if digits < 9 else 6 if digits < 12 else 7 if digits < 16 else 8 if digits < 20 else 9
        features.append([size, flags, min(7, len(w) // 4), xxhash.xxh32_intdigest(shape) % SIZES[3], 0])
        if first == before + 1:
            chain.append((len(spans) - 1, len(spans)))
            features[-1][4] |= 1
            features[-2][4] |= 2
        before = last
        spans.append((start, end))
        labels.append(label)
    groups: dict[str, list[int]] = {}
    for i, (a, b) in enumerate(spans):
        form = normal_form(text[a:b])
        if len(form) >= LEAST_FORM:
            groups.setdefault(form, []).append(i)
    skip = []
    for members in groups.values():
        # a star: as many edges as words, however often one is repeated
        hub = next((i for i in members if labels[i]), members[0])
        skip += [(hub, i) for i in members if i != hub]
    tied = {i for pair in skip for i in pair if labels[pair[0]] != labels[pair[1]]}
    skip += [(hubs[x], i) for x, i in repeats if x in hubs and i not in tied]
    return Words(spans, np.array(features, int).reshape(-1, len(SIZES)), np.array(labels, int), chain, skip)


# -- fitting -----------------------------------------------------------------------


@dataclass
class Field:
    """Log potentials: emissions by feature, chain by label pair, and the skip bonus for equal labels."""

    emission: np.ndarray
    chain: np.ndarray
    skip: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.emission[features + OFFSETS].sum(1)


def fit_emission(features: np.ndarray, labels: np.ndarray, weight: np.ndarray, steps: int = 200, ridge: float = 1.0) -> np.ndarray:
    """Multinomial logistic regression on counted feature tuples, by Adam."""
    w = np.zeros((sum(SIZES), LABELS))
    if not len(features):
        return w
    at, share = features + OFFSETS, weight / weight.sum()
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        s = w[at].sum(1)
        p = np.exp(s - s.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(p)), labels] -= 1
        g = ridge * w / weight.sum()
        for k in range(len(SIZES)):
            np.add.at(g, at[:, k], p * share[:, None])
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w


def unobserved(w: Words) -> dict[int, int]:
    """Nodes that no pattern touches but a skip edge ties to one it does, with that one's label."""
    out = {}
    for i, j in w.skip:
        if (w.labels[i] > 0) != (w.labels[j] > 0):
            out.setdefault(*((j, int(w.labels[i])) if w.labels[i] else (i, int(w.labels[j]))))
    return out


def logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


def potentials(words: np.ndarray, chain: np.ndarray, agree: int, pairs: int, rounds: int = 4) -> Field:
    """The field from counts.

    ``words``: rows of features, label, label that a repeat is tied to (0: observed), count;
    ``chain``: (labels, labels) counts of neighbours; of ``pairs`` skip edges between two
    nodes with a pattern's label ``agree`` have equal ones. The skip bonus is by how much
    one form raises the log odds of one label over those of any two nodes (``PRIOR_PAIRS``
    agree beforehand, so that a few pairs, or none, do not hide the rule); it and the
    chain come from observed nodes alone, the emissions also from the repeats' posteriors.
    """
    features, y, tied, n = words[:, : len(SIZES)], words[:, -3], words[:, -2], words[:, -1].astype(float)
    seen = tied == 0
    share = np.bincount(y[seen], n[seen], LABELS) + 1.0
    share /= share.sum()
    chance = float((share[1:] ** 2).sum() / share[1:].sum())
    skip = float(np.clip(logit((agree + PRIOR_PAIRS + 0.5) / (pairs + PRIOR_PAIRS + 1)) - logit(chance), 2, 12))
    by_chance = chain.sum(1, keepdims=True) * chain.sum(0, keepdims=True) / chain.sum()
    field = Field(fit_emission(features[seen], y[seen], n[seen]), np.clip(np.log(chain / by_chance), -3, 3), skip)
    for _ in range(rounds if (~seen).any() else 0):
        s = field.scores(features[~seen])
        s[np.arange(len(s)), tied[~seen]] += skip
        p = np.exp(s - s.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        soft = (p * n[~seen, None]).ravel()
        every = np.concatenate([features[seen], np.repeat(features[~seen], LABELS, 0)])
        field.emission = fit_emission(every, np.concatenate([y[seen], np.tile(np.arange(LABELS), len(p))]), np.concatenate([n[seen], soft]))
    return field


def fit(docs: DataFrame, text: str = "text", rows: int = TRAIN_DOCS) -> Field:
    """Potentials from the patterns' labels in about ``rows`` documents, one for each id
    (rows without an id are not learnt from; of several the least text is).

    Tasks hand on counts of feature tuples and of label pairs, not texts. See ``potentials``.
    """
    frame = hash_sample(docs.select(F.col("doc_id"), whole_text(text).alias("t")), "doc_id", rows).select("t")
    ship(docs.sparkSession)

    def run(batches):
        counts = Counter()
        for b in batches:
            for t in texts_of(b, "t"):
                if "@" not in t and not _DIGIT.search(t):
                    continue
                w = words_of(t, base_spans(t))
                tied = unobserved(w)
                counts.update(("word", *f, y, tied.get(i, 0)) for i, (f, y) in enumerate(zip(w.features.tolist(), w.labels.tolist())))
                for kind, pairs in (("chain", w.chain), ("skip", w.skip)):
                    counts.update((kind, 0, 0, 0, 0, 0, int(w.labels[i]), int(w.labels[j])) for i, j in pairs if i not in tied and j not in tied)
        keys = list(counts)
        cols = [pa.array([k[0] for k in keys], pa.string())] + [pa.array([k[i] for k in keys], pa.int32()) for i in range(1, 8)]
        yield pa.RecordBatch.from_arrays([*cols, pa.array([counts[k] for k in keys], pa.int64())], names=["what", *[f"f{i}" for i in range(5)], "y", "z", "n"])

    named = [*[f"f{i}" for i in range(5)], "y", "z"]
    got = frame.mapInArrow(run, "what string, " + ", ".join(f"{c} int" for c in named) + ", n bigint").groupBy("what", *named).agg(F.sum("n").alias("n")).toPandas()
    got = got.sort_values(["what", *named])
    chain = np.ones((LABELS, LABELS))  # one of each beforehand
    near = got[got.what == "chain"]
    np.add.at(chain, (near.y.to_numpy(int), near.z.to_numpy(int)), near.n.to_numpy(float))
    same = got[(got.what == "skip") & (got.y > 0) & (got.z > 0)]
    return potentials(got[got.what == "word"][[*named, "n"]].to_numpy(int), chain, int(same.n[same.y == same.z].sum()), int(same.n.sum()))


# -- inference ----------------------------------------------------------------------


def marginals(scores: np.ndarray, edges: np.ndarray, potentials: np.ndarray) -> np.ndarray:
    """Loopy sum-product: (nodes, labels) from node scores and (edges, labels, labels) potentials."""
    sends = np.concatenate([edges[:, 0], edges[:, 1]])
    gets = np.concatenate([edges[:, 1], edges[:, 0]])
    tables = np.concatenate([potentials, potentials.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    message = np.zeros((len(sends), scores.shape[1]))

    def belief():
        b = scores.copy()
        np.add.at(b, gets, message)
        return b

    for _ in range(ROUNDS):
        rest = belief()[sends] - message[back]
        x = rest[:, :, None] + tables
        top = x.max(1)
        new = top + np.log(np.exp(x - top[:, None, :]).sum(1))
        new -= new.max(1, keepdims=True)
        message = DAMPING * message + (1 - DAMPING) * new
    b = belief()
    p = np.exp(b - b.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def posteriors(w: Words, field: Field, hide: int | None = None) -> np.ndarray:
    """Marginals given the patterns' labels, that of the node ``hide`` left out."""
    scores = field.scores(w.features)
    seen = w.labels > 0
    if hide is not None:
        seen[hide] = False
    scores[seen] = -20.0
    scores[seen, w.labels[seen]] = 20.0
    same = field.skip * np.eye(LABELS)
    edges = np.array(w.chain + w.skip, int).reshape(-1, 2)
    return marginals(scores, edges, np.array([field.chain] * len(w.chain) + [same] * len(w.skip)))


def added_spans(text: str, base: list[tuple[int, int, int]], field: Field) -> list[tuple[int, int, int]]:
    """Spans that the field adds to the patterns'.

    A word is taken if its marginal is sure, no pattern span touches it, and a
    skip potential ties it to a word of a pattern's span. Words taken side by side
    with one label make one span.
    """
    if not base:
        return []  # nothing to be consistent with
    w = words_of(text, base)
    if not any((w.labels[i] > 0) != (w.labels[j] > 0) for i, j in w.skip):
        return []
    p, seen = posteriors(w, field), w.labels > 0
    best = p.argmax(1)
    sure = (p.max(1) >= SURE) & (best > 0) & ~seen
    taken = {i if seen[h] else h for h, i in w.skip if seen[h] != seen[i] and sure[i if seen[h] else h]}
    out: list[list[int]] = []
    joined = set(w.chain)
    last = -2
    for i in sorted(taken):
        a, b = w.spans[i]
        if (last, i) in joined and out and out[-1][1] == best[i] - 1:
            out[-1][2] = b
        else:
            a += len(text[a:b]) - len(text[a:b].lstrip("(\"'<[,;:"))
            out.append([a, int(best[i]) - 1, b])
        last = i
    trimmed = [(a, k, a + len(text[a:b].rstrip(".,;:!?)\"'>]"))) for a, k, b in out]
    return [s for s in trimmed if s[0] < s[2]]


SPANS = "spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def find(docs: DataFrame, field: Field, carry: list[str], text: str = "text", name: str = "spans", also: str | None = None) -> DataFrame:
    """``carry`` with the ``name`` column of spans of each row: kind, start, end (code points, end exclusive), base.

    Spans are sorted by start, then kind as listed. A null or empty text has no
    spans; every row gives one row, repeated rows alike; an empty table gives an
    empty one. Only ``carry`` and the text are read. ``also``: name of a further
    column with the text in which each span is replaced by its kind, as in
    ``<EMAIL>``; overlapping spans are replaced together, by the first one's kind.
    """
    inner = [f"c{i}" for i in range(len(carry))]
    frame = docs.select(*[F.col(c).alias(i) for c, i in zip(carry, inner)], whole_text(text).alias("t"))

    def make():
        def batch(b):
            texts = texts_of(b, "t")
            found = []
            for t in texts:
                base = base_spans(t)
                found.append(sorted([(*s, True) for s in base] + [(*s, False) for s in added_spans(t, base, field)]))
            spans = pa.array([[{"kind": KINDS[k], "start": a, "end": e, "base": own} for a, k, e, own in f] for f in found], _SPANS)
            return [spans, pa.array([masked(t, f) for t, f in zip(texts, found)], pa.string())] if also else [spans]

        return batch

    out = map_batches(frame, inner, SPANS + (", masked string" if also else ""), make)
    return out.select(*[F.col(i).alias(c) for i, c in zip(inner, carry)], F.col("spans").alias(name), *([F.col("masked").alias(also)] if also else []))


def masked(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    parts, at, end = [], 0, 0
    for a, k, e, _ in spans:
        if a >= end:
            parts += [text[at:a], f"<{KINDS[k].upper()}>"]
        end = at = max(end, e)
    return "".join(parts) + text[at:] if parts else text


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_pii(spark, sf_dir):
    """Contract query: personal data in every document."""
    docs = read(spark, sf_dir, "documents")
    out = find(docs, fit(docs), ["doc_id"])
    base = F.filter("spans", lambda s: s["base"])
    of = lambda kind: F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))
    counts = [F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def stage_pii(spark, docs, sf_dir):
    """Pipeline stage: each span gives way to its kind; a null text stays null."""
    out = find(docs, fit(docs), docs.columns, name="__pii_spans", also="__pii_text")
    new = {"text": F.when(F.col("text").isNotNull(), F.col("__pii_text"))}
    new["n_chars"] = F.when(F.col("text").isNotNull(), F.length("__pii_text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])
