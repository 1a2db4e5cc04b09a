"""Language identification by rank-order n-gram profiles.

A language's profile ranks its most frequent character n-grams (one to three
characters of a word with a blank at either end). A document is given to the
language whose ranks its own most frequent n-grams are least out of place in.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import fold_mod, map_batches, read, ship, texts_of, whole_text

#: Ranks of a profile, and of a document.
PROFILE, TOP = 400, 300
#: Documents whose n-grams are counted in one table.
TOGETHER = 64
#: Counts that a task gathers before it hands them on.
PENDING = 2_000_000

_MARK = np.int64(2**21 - 1)  # no character; marks shorter n-grams
_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Whether each code point is a letter; made once a process."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text's number, code) of every n-gram. Case and what is no letter don't count."""
    low = [t.lower() for t in texts]
    sizes = np.array([len(t) + 2 for t in low], np.int64)
    points = np.frombuffer("".join(f" {t} " for t in low).encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letter_table()[points]
    first = np.zeros(len(points), bool)
    first[np.cumsum(sizes) - sizes] = True
    keep = letter | first
    keep[1:] |= letter[:-1]
    text = np.repeat(np.arange(len(texts)), sizes)[keep]
    c = np.where(letter, points, 0)[keep].astype(np.int64)
    a, b, d = c[:-2], c[1:-1], c[2:]
    one = c > 0
    two = (c[:-1] > 0) | (c[1:] > 0)
    three = b > 0
    codes = [(_MARK << 42 | _MARK << 21 | c)[one], (_MARK << 42 | c[:-1] << 21 | c[1:])[two], (a << 42 | b << 21 | d)[three]]
    # an n-gram belongs to the text of its first character; a first blank is its own text's
    return np.concatenate([text[one], text[:-1][two], text[:-2][three]]), np.concatenate(codes)


def profiles_of(docs: DataFrame, text: str, lang: str, size: int = PROFILE) -> DataFrame:
    """(lang, code, rank): n-grams counted over all rows, each language's most frequent ranked.

    Tasks add up their own counts before the shuffle. Equally frequent n-grams
    are ranked by code. Null languages are left out.
    """
    ship(docs.sparkSession)
    frame = docs.select(F.col(lang).cast("string").alias("lang"), whole_text(text).alias("t")).filter("lang is not null")

    def run(batches):
        pending: dict[str, list[pd.Series]] = {}
        size = 0

        def handed_on():
            for name, parts in pending.items():
                total = pd.concat(parts).groupby(level=0).sum()
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(total), pa.string()), pa.array(total.index.to_numpy()), pa.array(total.to_numpy(np.int64))], names=["lang", "code", "n"])

        for b in batches:
            langs, texts = texts_of(b, "lang"), texts_of(b, "t")
            for name in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs) if x == name]
                code, seen = np.unique(ngrams(own)[1], return_counts=True)
                pending.setdefault(name, []).append(pd.Series(seen, index=code))
                size += len(code)
            if size > PENDING:
                pending = {k: [pd.concat(v).groupby(level=0).sum()] for k, v in pending.items()}
                size = sum(len(v[0]) for v in pending.values())
                if size > PENDING // 2:
                    yield from handed_on()
                    pending, size = {}, 0
        yield from handed_on()

    counts = frame.mapInArrow(run, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    return counts.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < size).select("lang", "code", "rank")


@dataclass
class Profiles:
    langs: list[str]
    codes: np.ndarray  # sorted
    ranks: np.ndarray  # (codes, languages); PROFILE where a language lacks the n-gram

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """The nearest language of each text, the first by name of equally near ones, and
        1 less the distance's share of the greatest possible one."""
        langs, scores = [], []
        for i in range(0, len(texts), TOGETHER):
            part = texts[i : i + TOGETHER]
            text, code = ngrams(part)
            at, known = pd.factorize(code, sort=True)
            counts = np.bincount(text * max(1, len(known)) + at, minlength=len(part) * len(known))
            cell = np.flatnonzero(counts)
            doc, gram = cell // max(1, len(known)), cell % max(1, len(known))
            order = np.lexsort((gram, -counts[cell], doc))
            doc, gram = doc[order], gram[order]
            rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
            doc, gram, rank = doc[rank < TOP], gram[rank < TOP], rank[rank < TOP]
            place = np.full((len(known), len(self.langs)), PROFILE)
            if len(self.codes):
                j = np.minimum(np.searchsorted(self.codes, known), len(self.codes) - 1)
                place = np.where((self.codes[j] == known)[:, None], self.ranks[j], PROFILE)
            apart = np.where(place[gram] == PROFILE, PROFILE, np.abs(place[gram] - rank[:, None]))
            size = np.bincount(doc, minlength=len(part))
            far = np.stack([np.bincount(doc, apart[:, k], len(part)) for k in range(len(self.langs))], 1) if self.langs else np.zeros((len(part), 0))
            for d in range(len(part)):
                if not size[d] or not self.langs:
                    langs.append("und")
                    scores.append(0.0)
                else:
                    k = int(far[d].argmin())
                    langs.append(self.langs[k])
                    scores.append(float(np.clip(1 - far[d, k] / (size[d] * PROFILE), 0, 1)))
        return langs, scores


def collect_profiles(ranked: DataFrame) -> Profiles:
    """At most ``PROFILE`` rows for each language reach the driver."""
    got = ranked.toPandas()
    langs = sorted(got.lang.unique())
    codes = np.unique(got.code.to_numpy(np.int64))
    ranks = np.full((len(codes), len(langs)), PROFILE)
    for k, name in enumerate(langs):
        own = got[got.lang == name]
        ranks[np.searchsorted(codes, own.code.to_numpy(np.int64)), k] = own["rank"].to_numpy()
    return Profiles(langs, codes, ranks)


def identify(docs: DataFrame, profiles: Profiles, carry: list[str], text: str = "text") -> DataFrame:
    """``carry`` with ``lang_pred`` and ``score`` of each row.

    A text that is null or has no letter gets ``und`` and 0, and so does every
    text if nothing was learnt. Repeated rows are judged alike, an empty table
    gives an empty one, whole texts are counted. Only ``carry`` and the text are
    read.
    """
    inner = [f"c{i}" for i in range(len(carry))]
    frame = docs.select(*[F.col(c).alias(i) for c, i in zip(carry, inner)], whole_text(text).alias("t"))

    def make():
        def batch(b):
            langs, scores = profiles.predict(texts_of(b, "t"))
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

        return batch

    out = map_batches(frame, inner, "lang_pred string, score double", make)
    return out.select(*[F.col(i).alias(c) for i, c in zip(inner, carry)], "lang_pred", "score")


def op10_language(spark, sf_dir):
    """Contract query: language of every document; rows of remainder 2 are held out of learning."""
    docs = read(spark, sf_dir, "documents")
    held_out = fold_mod("doc_id", 4) == 2
    profiles = collect_profiles(profiles_of(docs.filter(~held_out), "text", "lang"))
    return identify(docs, profiles, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
