"""Rows that every operator has to cope with."""

from __future__ import annotations

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """documents-like rows from (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows(word: str = "word") -> list[tuple]:
    """Null id, null and empty texts, blanks, a very long text, repeated rows, odd characters."""
    return [
        (1, None),
        (2, ""),
        (3, " \n\t\x0b \r\n"),
        (4, f"{word} " * 30_000),
        (5, "x" * 100_000),
        (6, "same row"),
        (6, "same row"),
        (None, "a row without an id"),
        (7, "zé 日本語 \U0001f389 ́combining space line\u0000null"),
    ]


def with_clashes(df):
    """Extra columns whose names the operators use themselves."""
    names = ["t", "c0", "c1", "n", "node", "id", "ids", "spans", "items", "score", "kept", "n_words", "key", "a", "b", "row", "place", "p", "masked", "decoded"]
    return df.withColumns({c: F.lit("clash") for c in names})
