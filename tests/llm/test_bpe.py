"""Byte-pair codec against the tokenizers library, and round trips."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tests.llm.helpers import docs, odd_rows, with_clashes
from txrisk.llm import bpe

PATH = bpe.default_vocabulary()
LIBRARY = Tokenizer.from_file(PATH)
CODEC = bpe.codec(PATH)

TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "I'm you're WE'LL  it's", "<|endoftext|>", "a<|endoftext|> <|endoftext|><|endoftext|>b", "<|endoftext",
    "tab\tnbsp x  　y z", "½ Ⅷ ٣ 12345", "\U0001f389\U0001f468‍\U0001f469‍\U0001f467", "é ́", "\x00\x1f\x7f", "a" * 5000, "-" * 999 + "=" * 77,
]


def ids_of(text):
    return np.frombuffer(CODEC.encode(text), "<u4").tolist()


def check(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids_of(text) == want
    assert CODEC.decode(CODEC.encode(text)) == LIBRARY.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", TEXTS)
def test_equals_library(text):
    check(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list(" \n\t'abcst,.0<|>endoftxé ")), st.characters(codec="utf-8")), max_size=40))
def test_equals_library_on_any_text(text):
    check(text)


def test_equal_ranks_merge_leftmost_first():
    assert ids_of("aaaaa") == LIBRARY.encode("aaaaa").ids
    assert CODEC.symbols(b"") == [] and len(CODEC.symbols(b"\xff\xfe")) == 2


def test_cache_generations_keep_results(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    c = bpe.Codec(PATH)
    for text in ["one two three four five six seven", "two one nine ten", "one two"] * 3:
        assert np.frombuffer(c.encode(text), "<u4").tolist() == LIBRARY.encode(text).ids
        assert len(c.word) <= 4 and len(c.piece) <= 4


def test_each_word_is_encoded_once_and_kept_once():
    c = bpe.Codec(PATH)
    made, symbols = [], c.symbols
    c.symbols = lambda data: made.append(data) or symbols(data)
    for text in ["zero one two one, three", "zero \nzero one two three, one", "zero one, two three, zero"]:
        assert np.frombuffer(c.encode(text), "<u4").tolist() == LIBRARY.encode(text).ids
    assert len(made) == len(set(made))
    assert {"one", "one,", "two", "three"} <= set(c.word) and not {" one", " two", " three"} & set(c.piece)


def test_letters_alone_are_one_piece_in_every_script():
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    letters = "".join(filter(str.isalpha, every))
    assert CODEC.pieces.findall(" " + letters) == [" " + letters]
    assert set(bpe.regex.findall(r"\s", every)) == bpe.WHITE


@pytest.mark.parametrize("space", [" ", "  ", " \n", "\n ", "\t", "\x1f", " \x1f ", "\u3000 ", " '", "\n\n"])
def test_loose_spaces_anywhere(space):
    for text in ["a, b c", "don't stop", "1 2 three&&& x"]:
        for i in range(len(text) + 1):
            check(text[:i] + space + text[i:])
            check(f"w {text[:i]}{space}{text[i:]} w<|endoftext|>{text[i:]}{space}")


def test_odd_rows(spark):
    rows = odd_rows("thing")
    out = bpe.encode_decode(with_clashes(docs(spark, rows)), ["doc_id", "text", "ids"][:2]).collect()
    assert len(out) == len(rows)
    for r in out:
        text = r.text or ""
        assert r.decoded == text
        assert np.frombuffer(r.ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert bpe.encode_decode(docs(spark, []), ["doc_id"]).count() == 0


def test_query_over_the_whole_table(spark):
    got = {r.doc_id: r for r in bpe.op2_bpe(spark, SMALL).collect()}
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(table)
    for r in table:
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
