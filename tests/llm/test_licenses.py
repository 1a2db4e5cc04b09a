"""Alignment, and planted notices."""

from __future__ import annotations

import random

from tests.conftest import SMALL
from tests.llm.helpers import docs, odd_rows, with_clashes
from txrisk.llm import licenses


def brute_lis(values):
    best = [1] * len(values)
    for i in range(len(values)):
        best[i] = max([best[j] + 1 for j in range(i) if values[j] < values[i]], default=1)
    return max(best, default=0)


def test_longest_increasing_subsequence():
    rnd = random.Random(1)
    for _ in range(300):
        v = rnd.sample(range(50), rnd.randint(0, 15))
        at = licenses.increasing(v)
        got = [v[i] for i in at]
        assert got == sorted(set(got)) and at == sorted(at) and len(got) == brute_lis(v)


def test_alignment_is_increasing_and_equal():
    rnd = random.Random(2)
    for _ in range(300):
        a, b = ([rnd.randrange(12) for _ in range(rnd.randint(0, 25))] for _ in range(2))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    whole = list(range(30))
    assert len(licenses.align(whole, whole)) == 30
    # moved, changed and repeated words: anchors carry the alignment across
    edited = [99, *whole[:10], 7, 7, *whole[12:20], 50, *whole[20:]]
    assert len(licenses.align(edited, whole)) >= 27


def test_finds_equal_alignment_at_every_place(spark):
    """Random damaged copies: what is found from the rare words' places is what alignment at all places finds.

    The templates share no words: a stray one can widen a stretch that is found from another place.
    """
    rnd = random.Random(8)
    word = lambda of: f"{of}{rnd.randrange(40)}"
    templates = [(f"L{i}", " ".join(word(i) for _ in range(n))) for i, n in enumerate((30, 45, 60))]
    texts = []
    for _ in range(60):
        out = [word("x") for _ in range(rnd.randrange(40))]
        for _ in range(rnd.randrange(3)):
            for w in rnd.choice(templates)[1].split():
                kind = rnd.random()
                out += [] if kind < 0.08 else [w, "other"] if kind < 0.14 else [w]
            out += ["plain"] * rnd.randrange(5, 40)
        texts.append(" ".join(out))
    scanner = licenses.scanner(docs(spark, list(enumerate(texts))), templates, "text")
    some = 0
    for text in texts:
        ids = [scanner.vocabulary.get(w, -1) for w in licenses.words_of(text)]
        found = []
        for t in scanner.templates:
            n = len(t.words)
            for s in range(-n, len(ids)):
                for slack in (0, n // 4 + 2, n):
                    low = max(0, s - slack)
                    pairs = licenses.align(ids[low : max(0, s + n + slack)], t.words)
                    if len(pairs) >= t.least:
                        found.append((len(pairs), low + pairs[0][0], low + pairs[-1][0] + 1, t.name))
                        break
        best = []
        for _, a, b, name in sorted(found, key=lambda f: (-f[0], f[2] - f[1], f[1], f[3])):
            if all(b <= x or a >= y for x, y, _ in best):
                best.append((a, b, name))
        got = scanner.find(text)[1]
        assert [f[2] for f in got] == [f[2] for f in sorted(best)], text
        assert all(a < y and x < b for (a, b, *_), (x, y, _) in zip(got, sorted(best)))
        some += len(got)
    assert some > 30


def test_planted_notices_and_odd_rows(spark):
    mit = licenses.TEMPLATES[6][1]
    reflowed = mit.replace(" ", "\n ").replace("Software", "software").replace("merge, ", "")
    rows = odd_rows("license") + [
        (20, "Some prose. Released under the MIT License. More prose about a license."),
        (21, "x " * 50 + reflowed + " the end"),
        (22, "Licensed under the Apache License, Version 2.0.\n" * 3),
        (23, "A license to walk. The version is 3. Public works are general."),
        (24, "This work is licensed under the GNU General Public License, version 3. Released under the MIT License."),
    ]
    out = {}
    for r in licenses.scan(with_clashes(docs(spark, rows)), ["doc_id", "text", "spans"]).collect():
        out.setdefault(r.doc_id, []).append(r)
    names = {i: [s.name for s in r[0].licenses] for i, r in out.items()}
    assert sum(map(len, out.values())) == len(rows)
    assert names[20] == ["MIT"] and names[21] == ["MIT"] and names[22] == ["Apache-2.0"] * 3 and names[23] == [] and names[24] == ["GPL-3.0", "MIT"]
    assert all(not names[i] for i in (1, 2, 3, 4, 5, 6, None, 7))
    s = out[20][0].licenses[0]
    assert (s.start, s.end, s.coverage) == (2, 7, 1.0)
    assert licenses.scan(docs(spark, []), ["doc_id"]).count() == 0


def test_query_over_the_whole_table(spark):
    lines = {"Apache-2.0": "Licensed under the Apache License, Version 2.0.", "MIT": "Released under the MIT License.",
             "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0."}
    got = {r.doc_id: set(r.licenses.split(",")) - {""} for r in licenses.op3_licenses(spark, SMALL).collect()}
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(table)
    for r in table:
        assert {n for n, line in lines.items() if line in (r.text or "")} == got[r.doc_id], r.doc_id


def test_a_notice_without_its_rarest_words_is_found(spark):
    notice = dict(licenses.TEMPLATES[4:5])["GPL-3.0"]
    lacking = " ".join(w for w in notice.split() if w not in ("redistribute", "option)", "merchantability", "MERCHANTABILITY", "FITNESS"))
    half = notice.split()
    parted = " ".join(half[:40] + [f"other{i}" for i in range(60)] + half[40:])
    got = {r.doc_id: [s.name for s in r.licenses] for r in licenses.scan(docs(spark, [(1, lacking), (2, "prose " * 30 + lacking), (3, parted)]), ["doc_id"]).collect()}
    assert got == {1: ["GPL-3.0"], 2: ["GPL-3.0"], 3: ["GPL-3.0"]}


def test_keys_are_so_many_that_no_copy_lacks_them_all():
    rnd = random.Random(3)
    words = {w: i for i, w in enumerate(dict.fromkeys(w for _, t in licenses.TEMPLATES for w in licenses.words_of(t)))}
    for name, text in licenses.TEMPLATES:
        split = licenses.words_of(text)
        t = licenses.Template(name, [words[w] for w in split], [])
        may_lack = len(split) - t.least
        t.keys = [(t.words[p], p) for p in rnd.sample(range(len(split)), may_lack + 1)]
        gone = {p for _, p in t.keys[:may_lack]}
        copy = b" ".join(w for p, w in enumerate(split) if p not in gone).decode()
        assert [f[2] for f in licenses.Scanner(words, [t]).find(copy)[1]] == [name], name


def test_every_template_is_told_from_the_others(spark):
    rows = [(i, f"Some prose before it. {text} And some prose after it.") for i, (_, text) in enumerate(licenses.TEMPLATES)]
    got = {r.doc_id: [s.name for s in r.licenses] for r in licenses.scan(docs(spark, rows), ["doc_id"]).collect()}
    assert {i: [name] for i, (name, _) in enumerate(licenses.TEMPLATES)} == got


def test_common_notices_are_covered():
    names = {n.rsplit("-", 1)[0] if n.startswith("CC-") else n for n, _ in licenses.TEMPLATES}
    assert names >= {"Apache-2.0", "MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "CC0-1.0", "Unlicense"}
    assert names >= {"CC-BY", "CC-BY-SA", "CC-BY-NC", "CC-BY-ND", "CC-BY-NC-SA", "CC-BY-NC-ND"}
