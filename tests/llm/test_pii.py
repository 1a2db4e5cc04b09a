"""Patterns against plain regular expressions, message passing against enumeration."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np

from tests.conftest import SMALL
from tests.llm.helpers import docs, odd_rows, with_clashes
from txrisk.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
FLAT = pii.Field(np.zeros((sum(pii.SIZES), pii.LABELS)), np.zeros((pii.LABELS, pii.LABELS)), 4.0)


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


def luhn(digits):
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(c)))) for c in even)) % 10 == 0


def test_patterns_on_random_text():
    rnd = random.Random(3)
    for i in range(30_000):
        alphabet = ("a1.@- +(5Zé%\n", "1234.05 +-", "ab@.-")[i % 3]
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_are_linear():
    for text in ("1" * 100_000, "a" * 100_000 + "@", "a@" * 50_000, "1." * 50_000, "+5" + "." * 100_000, "9 " * 50_000):
        pii.base_spans(text)
        pii.added_spans(text, pii.base_spans(text), FLAT)


def test_messages_equal_enumeration_on_a_tree():
    rng = np.random.default_rng(5)
    scores, edges = rng.normal(size=(5, 3)), np.array([[0, 1], [1, 2], [1, 3], [3, 4]])
    tables = rng.normal(size=(4, 3, 3))
    want = np.zeros((5, 3))
    for y in itertools.product(range(3), repeat=5):
        w = np.exp(sum(scores[i, y[i]] for i in range(5)) + sum(tables[e, y[a], y[b]] for e, (a, b) in enumerate(edges)))
        for i in range(5):
            want[i, y[i]] += w
    want /= want.sum(1, keepdims=True)
    assert np.abs(pii.marginals(scores, edges, tables) - want).max() < 1e-3


def test_skip_potentials_spread_labels():
    text = "mail bosbt.42@mail8.example.com or +1 (499) 555-6503. Later: 555-6503, bosbt.42 and 4111111111111112, 12 apples."
    base = pii.base_spans(text)
    added = pii.added_spans(text, base, FLAT)
    assert [(pii.KINDS[k], text[a:b]) for a, k, b in added] == [("phone", "555-6503"), ("email", "bosbt.42")]
    # without a pattern's span there is nothing to agree with
    assert pii.added_spans("bosbt.42 and 555-6503 and 555-6503", [], FLAT) == []


PARTS = {
    "email": lambda d: [d.partition("@")[0]],
    "card": lambda d: [d[-8:], f"{d[-8:-4]} {d[-4:]}", f"{d[-8:-4]}-{d[-4:]}."],
    "phone": lambda d: [d[-8:], f"{d[-7:-4]}-{d[-4:]}", f"{d[-8:-4]} {d[-4:]}."],
}


def test_the_fitted_field_finds_repeats(spark):
    """On the field that the query fits: pattern labels hidden from it, and parts of a
    document's own spans written again behind it. Nothing is added without a repeat."""
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    field = pii.fit(table)
    hidden, planted = [], {k: [] for k in PARTS}
    for r in table.select("text").collect():
        text = r.text or ""
        base = pii.base_spans(text)
        w = pii.words_of(text, base)
        if not base:
            assert not pii.added_spans(text, base, field)
            continue
        assert len(pii.added_spans(text, base, field)) <= len(pii.unobserved(w))
        for i, j in w.skip:
            if w.labels[i] and w.labels[j]:
                hidden.append(pii.posteriors(w, field, hide=j)[j, w.labels[j]] >= pii.SURE)
        for a, k, b in base:
            datum = text[a:b] if pii.KINDS[k] == "email" else "".join(c for c in text[a:b] if c.isdigit())
            for part in PARTS.get(pii.KINDS[k], lambda d: [])(datum):
                longer = f"{text} some prose, then {part} 3 times"
                part = part.rstrip(".")
                if len(pii.normal_form(part)) >= pii.LEAST_FORM and pii.base_spans(longer) == base:
                    planted[pii.KINDS[k]].append(part in [longer[x:y] for x, _, y in pii.added_spans(longer, base, field)])
    assert len(hidden) >= 50 and np.mean(hidden) >= 0.9
    for kind, found in planted.items():
        assert len(found) >= 100 and np.mean(found) >= 0.9, (kind, np.mean(found))


def test_repeats_are_left_unobserved_in_the_fit():
    """Repeats that no pattern matches, many of them: as label 0 they would teach the field to
    leave them out; unobserved they are found, while the same shape elsewhere stays out."""
    rnd = random.Random(8)
    words, agree = [], 0
    chain = np.ones((pii.LABELS, pii.LABELS))
    for _ in range(300):
        d = "".join(rnd.choice("123456789") for _ in range(10))
        text = f"call +1 {d[:3]} {d[3:6]}-{d[6:]} or {d[3:6]}-{d[6:]}, id {rnd.randint(100, 999)}-{rnd.randint(1000, 9999)}"
        w = pii.words_of(text, pii.base_spans(text))
        tied = pii.unobserved(w)
        assert list(tied.values()) == [4]
        words += [(*f, y, tied.get(i, 0), 1) for i, (f, y) in enumerate(zip(w.features.tolist(), w.labels.tolist()))]
    field = pii.potentials(np.array(words), chain, agree, 0)
    text = "call +1 234 567-8901 some day. Or 567-8901, not 667-8901"
    assert [(pii.KINDS[k], text[a:b]) for a, k, b in pii.added_spans(text, pii.base_spans(text), field)] == [("phone", "567-8901")]
    none = pii.potentials(np.zeros((0, len(pii.SIZES) + 3), int), chain, 0, 0)
    assert np.isfinite(none.skip) and not none.emission.any()


def test_masking():
    text = "a b@c.de +1 234 567 8901x"
    spans = [(*s, True) for s in pii.base_spans(text)]
    assert pii.masked(text, spans) == "a <EMAIL> <PHONE>x"


def test_odd_rows(spark):
    rows = odd_rows() + [(8, "x@y.zz"), (9, "call +1 (499) 555-6503 now")]
    frame = with_clashes(docs(spark, rows))
    field = pii.fit(frame)
    out = pii.find(frame, field, ["doc_id", "text", "spans"], name="found").collect()
    assert len(out) == len(rows)
    assert {r.doc_id: len(r.found) for r in out}[8] == 1
    assert all(not r.found for r in out if r.doc_id not in (8, 9))
    stage = {r.doc_id: r for r in pii.stage_pii(spark, frame, SMALL).collect()}
    assert stage[8].text == "<EMAIL>" and stage[8].n_chars == 7 and stage[9].text == "call <PHONE> now"
    assert stage[1].text is None and stage[2].text == "" and stage[8].spans == "clash"
    empty = docs(spark, [])
    assert pii.find(empty, pii.fit(empty), ["doc_id"]).count() == 0


def test_query_over_the_whole_table(spark):
    got = {r.doc_id: r for r in pii.op1_pii(spark, SMALL).collect()}
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(table)
    found = 0
    for r in table:
        spans = brute(r.text or "")
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        g = got[r.doc_id]
        assert g.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (g.n_email, g.n_ip, g.n_card, g.n_phone) == tuple(sum(s[1] == k for s in spans) for k in range(4))
        assert set(text.split(",")) <= set(g.spans.split(",")) or not text
        found += len(spans)
    assert found


def test_repeats_without_digits_and_in_groups_are_found():
    def added(text):
        return [(pii.KINDS[k], text[a:b]) for a, k, b in pii.added_spans(text, pii.base_spans(text), FLAT)]

    assert added("mail anna.smith@x.com and then some prose to (Anna.Smith), not to annasmith") == [("email", "Anna.Smith")]
    assert added("call +44 20 7946 0958 or, at home, 20 7946 0958. Not 20 7946 and not 30 7946 0959") == [("phone", "20 7946 0958")]
    assert added("call +442079460958 or later 20 7946 0958 3 times") == [("phone", "20 7946 0958")]
    assert added("card 4111 1111 1111 1111, its end is 1111 1111") == [("card", "1111 1111")]
    assert added("write <anna.smith@x.com> or anna.smith") == [("email", "anna.smith")]
    assert added("anna.smith and 20 7946 0958") == []
    for text in ("anna.smith@x.com " + "anna.smith " * 20_000, "+44 20 7946 0958 and " + "20 7946 0958 " * 20_000, "+44 20 7946 0958 and " + "20 " * 50_000):
        pii.added_spans(text, pii.base_spans(text), FLAT)
