"""License scans by patience alignment.

A template is looked for around its rarest words: so many of its word places that
a copy cannot lack them all and still count as found. There, the words that are
unique both in the stretch of text and in the template are anchors; their longest
increasing subsequence fixes the alignment, and the gaps between anchors are
aligned the same way. The share of the template's words that the alignment
covers decides. A copy may have as many other words in it as the template has.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import map_batches, read, ship, texts_of, whole_text
from txrisk.llm.decontam import words_of

#: Share of a template's words from which it counts as found.
LEAST_COVERAGE = 0.85

#: Public license notices (fixed values).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software.",
    ),
]


def _gnu(kind: str, noun: str, version: str) -> str:
    return (
        f"This {noun} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software "
        f"Foundation, either version {version} of the License, or (at your option) any later version. This {noun} is distributed in the hope that it will be useful, but WITHOUT ANY "
        f"WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details."
    )


_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list "
    "of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written "
    "permission. "
)
_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT '
    "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_CC = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
#: Names that stand in "Released under the ... License." and the like, one form each.
_NAMED = [
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("ISC", "Released under the ISC License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC0-1.0", "This work is licensed under a Creative Commons CC0 1.0 Universal License."),
    ("Unlicense", "Released under the Unlicense."),
]
TEMPLATES += _NAMED
#: A near form of another license is told from it by being a template too.
TEMPLATES += [(f"CC-{k}-{v}", f"Licensed under CC {k} {v}.") for k in _CC for v in ("3.0", "4.0") if (k, v) != ("BY-NC", "4.0")]
TEMPLATES += [
    (f"CC-{k}-{v}", f"This work is licensed under a Creative Commons {long} {v} {scope} License.") for k, long in _CC.items() for v, scope in (("3.0", "Unported"), ("4.0", "International"))
]
TEMPLATES += [
    ("GPL-2.0", _gnu("", "program", "2")),
    ("LGPL-2.1", _gnu("Lesser ", "library", "2.1")),
    ("LGPL-3.0", _gnu("Lesser ", "program", "3")),
    ("LGPL-3.0", _gnu("Lesser ", "library", "3")),
    ("AGPL-3.0", _gnu("Affero ", "program", "3")),
    ("BSD-2-Clause", _BSD + _DISCLAIMER),
    ("BSD-3-Clause", _BSD + _BSD_3 + _DISCLAIMER),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. " + _ISC,
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    (
        "CC0-1.0",
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is "
        "distributed without any warranty. You should have received a copy of the CC0 Public Domain Dedication along with this software.",
    ),
    (
        "CC0-1.0",
        "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
        "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
]


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience piles with back pointers."""
    tops, at, back = [], [], []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of equal words of ``a`` and ``b``, increasing in both."""
    pairs, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            pairs.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            pairs.append((j, m))
        if i == j or k == m:
            continue
        many_a, many_b = Counter(a[i:j]), Counter(b[k:m])
        place = {w: p for p, w in enumerate(b[k:m], k) if many_b[w] == 1}
        anchors = [(p, place[w]) for p, w in enumerate(a[i:j], i) if many_a[w] == 1 and w in place]
        anchors = [anchors[x] for x in increasing([q for _, q in anchors])]
        if not anchors:
            continue
        pairs += anchors
        edges = [(i - 1, k - 1), *anchors, (j, m)]
        todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:])]
    return sorted(pairs)


@dataclass
class Template:
    name: str
    words: list[int]
    keys: list[tuple[int, int]]  # (word, place in the template): one of them is in every copy

    @property
    def least(self) -> int:
        return math.ceil(LEAST_COVERAGE * len(self.words))


@dataclass
class Scanner:
    vocabulary: dict[bytes, int]
    templates: list[Template]

    def __post_init__(self):
        size = len(self.vocabulary)
        self.is_key = np.zeros(size + 1, bool)  # the last for words of no template
        self.keyed: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i, t in enumerate(self.templates):
            for w, place in t.keys:
                self.is_key[w] = True
                self.keyed[w].append((i, place))
        self.has = [np.bincount(t.words, minlength=size + 1) for t in self.templates]

    def find(self, text: str) -> tuple[int, list[tuple[int, int, str, float]]]:
        """The number of words, and (start, end, name, coverage) of the licenses found.

        Of overlapping finds the one that covers more words stays, of these the one
        that covers more of its template.
        """
        words = words_of(text)
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        starts = defaultdict(set)
        for p in np.flatnonzero(self.is_key[ids]).tolist():
            for i, place in self.keyed[int(ids[p])]:
                starts[i].add(p - place)
        found = []
        for i, at in starts.items():
            t = self.templates[i]
            n = len(t.words)
            for s in at:
                widest = np.bincount(ids[max(0, s - n) : max(0, s + 2 * n)] % len(self.is_key), minlength=len(self.is_key))
                if np.minimum(widest, self.has[i]).sum() < t.least:
                    continue
                # the bare stretch first: with words of a neighbouring copy in it, few are unique
                for slack in (0, n // 4 + 2, n):
                    low = max(0, s - slack)
                    pairs = align(ids[low : max(0, s + n + slack)].tolist(), t.words)
                    if len(pairs) >= t.least:
                        found.append((len(pairs), low + pairs[0][0], low + pairs[-1][0] + 1, t.name, len(pairs) / n))
                        break
        out = []
        for _, a, b, name, share in sorted(found, key=lambda f: (-f[0], -f[4], f[2] - f[1], f[1], f[3])):
            if all(b <= x or a >= y for x, y, _, _ in out):
                out.append((a, b, name, share))
        return len(words), sorted(out)


def scanner(docs: DataFrame, templates: list[tuple[str, str]], text: str) -> Scanner:
    """Choose each template's keys by how few documents hold the words.

    A copy lacks at most ``n - least`` of the ``n`` places, so one of any
    ``n - least + 1`` is in it.

    The counts are over all documents; a task hands on, and the driver collects,
    at most one row for each word of the templates.
    """
    split = [(name, words_of(t)) for name, t in templates]
    vocabulary: dict[bytes, int] = {}
    for _, words in split:
        for w in words:
            vocabulary.setdefault(w, len(vocabulary))
    ship(docs.sparkSession)

    def run(batches):
        counts = np.zeros(len(vocabulary), np.int64)
        for b in batches:
            for t in texts_of(b, "t"):
                for w in vocabulary.keys() & set(words_of(t)):
                    counts[vocabulary[w]] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["w", "n"])

    got = docs.select(whole_text(text).alias("t")).mapInArrow(run, "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n")).toPandas()
    seen = dict(zip(got.w, got.n))
    out = []
    for name, words in split:
        ids = [vocabulary[w] for w in words]
        t = Template(name, ids, [])
        rare = sorted(range(len(ids)), key=lambda p: (seen.get(ids[p], 0), p))
        t.keys = [(ids[p], p) for p in rare[: len(ids) - t.least + 1]]
        out.append(t)
    return Scanner(vocabulary, [t for t in out if t.words])


FOUND = "n_words bigint, licenses array<struct<start:bigint,end:bigint,name:string,coverage:double>>"
_FOUND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("coverage", pa.float64())]))


def scan(docs: DataFrame, carry: list[str], text: str = "text", templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """``carry`` with ``n_words`` and ``licenses``: start and end (word numbers), name, coverage.

    ``templates``: (name, text) pairs, several to a name if wished; they are sent
    to the tasks, so their number is meant to be that of a license list. A null or
    empty text has no words and no license. Repeated rows are scanned alike, an
    empty table gives an empty one, whole texts are read. Only ``carry`` and the
    text are read.
    """
    inner = [f"c{i}" for i in range(len(carry))]
    find = scanner(docs, templates or TEMPLATES, text)
    frame = docs.select(*[F.col(c).alias(i) for c, i in zip(carry, inner)], whole_text(text).alias("t"))

    def make():
        def batch(b):
            found = [find.find(t) for t in texts_of(b, "t")]
            rows = [[{"start": a, "end": e, "name": n, "coverage": c} for a, e, n, c in f] for _, f in found]
            return [pa.array([n for n, _ in found], pa.int64()), pa.array(rows, _FOUND)]

        return batch

    out = map_batches(frame, inner, FOUND, make)
    return out.select(*[F.col(i).alias(c) for i, c in zip(inner, carry)], "n_words", "licenses")


def op3_licenses(spark, sf_dir):
    """Licenses in every document: names, and name:start:end of each place."""
    out = scan(read(spark, sf_dir, "documents"), ["doc_id"])
    names = F.array_sort(F.array_distinct(F.transform("licenses", lambda s: s["name"])))
    places = F.transform("licenses", lambda s: F.concat_ws(":", s["name"], s["start"], s["end"]))
    return out.select(
        "doc_id",
        "n_words",
        F.size("licenses").cast("bigint").alias("n_places"),
        F.array_join(names, ",").alias("licenses"),
        F.array_join(places, ",").alias("places"),
    )
