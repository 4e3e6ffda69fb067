"""Operator 7, license scans: winnowed template fingerprints, an inverted index, then banded alignment.

Templates are normalised to words (lower-case ASCII letters and digits). Every run of ``GRAM`` words is hashed; of
``WINDOW`` consecutive hashes the smallest is kept (winnowing), so any shared run of ``GRAM + WINDOW - 1`` words
shares a kept hash. The inverted index maps a hash to template places. A text looks all its runs up, which finds
at least what a winnowed text would; each match is a place in the text and a diagonal of a template. Matches
of a template on near diagonals are one candidate. Each candidate region is aligned with its template inside a band around the
diagonals, again beside each find until no match is left (words equal 1, gap or substitution -1, ends free), and reported with its span in the original text and
the matched share of the template, if that reaches ``MIN_COVERAGE`` (``MIN_SHORT`` for templates of fewer than ``SHORT`` words) and
the words that tell the license from its neighbours (``TELLING``: names and versions) stand in the text as in the template, word after word.

Bound: the index holds the templates, a table kept far below the memory of a task (``MAX_TEMPLATE_WORDS`` in
all, checked). Texts are read once and whole, nothing is shuffled.

Defined results: null or empty text has no license. A notice whose name or version is not among the templates is no find. Of overlapping finds of several templates the one with more
matched words stays (ties: more coverage, then name). Repeated rows are reported each. Columns of the documents other than the
text are read by ``carry`` alone, so no name of theirs can clash with ``finds``.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import map_texts, prepare

GRAM = 3
WINDOW = 2
BAND = 8
MIN_COVERAGE = 0.6
MIN_SHORT = 0.8
SHORT = 16
MAX_TEMPLATE_WORDS = 5_000_000

WORD = re.compile(r"[a-z0-9]+")
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}

#: Short notices and grants as their publishers word them.
_BSD_TWO = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
            "the following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_THIRD = (" Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
              "derived from this software without specific prior written permission.")
_BSD_DISCLAIMER = (" THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
                   "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
                   "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
                   "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
                   "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
                   "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
                   "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
            "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
            "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
            "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
            "OTHER DEALINGS IN THE SOFTWARE."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
                "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
                "GNU General Public License for more details."),
    ("BSD-3-Clause", _BSD_TWO + _BSD_THIRD),
    ("BSD-3-Clause", _BSD_TWO + _BSD_THIRD + _BSD_DISCLAIMER),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-2-Clause", _BSD_TWO),
    ("BSD-2-Clause", _BSD_TWO + _BSD_DISCLAIMER),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
            "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
            "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
            "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
            "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
            "SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
                "which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 "
                "which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
             "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
             "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
             "restrictions:"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                  "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                  "purpose, commercial or non-commercial, and by any means."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                "this work"),
]

#: GNU licenses by name and version: a notice in one sentence and the notice of a program's source files.
_GNU = [("GPL", "General", "2"), ("GPL", "General", "3"), ("LGPL", "Lesser General", "2.1"), ("LGPL", "Lesser General", "3"),
        ("AGPL", "Affero General", "3")]
for _short, _long, _version in _GNU:
    _name = f"{_short}-{_version}" + ("" if "." in _version else ".0")
    _full = f"GNU {_long} Public License"
    if _name != "GPL-3.0":
        TEMPLATES.append((_name, f"This work is licensed under the {_full}, version {_version}"))
        TEMPLATES.append((_name, f"This program is free software: you can redistribute it and/or modify it under the terms of the {_full} as "
                                 f"published by the Free Software Foundation, either version {_version} of the License, or (at your option) any "
                                 "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
                                 "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
                                 f"{_full} for more details."))
    TEMPLATES.append((_name, f"Licensed under the {_full} v{_version}" + ("" if "." in _version else ".0")))

#: The six Creative Commons licenses in two versions, by their short and long names.
_CC = [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
       ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")]
for _short, _long in _CC:
    TEMPLATES.append((f"CC-{_short}-4.0", f"Licensed under CC {_short} 4.0"))
    TEMPLATES.append((f"CC-{_short}-3.0", f"Licensed under CC {_short} 3.0"))
    TEMPLATES.append((f"CC-{_short}-4.0", f"This work is licensed under a Creative Commons {_long} 4.0 International License"))
    TEMPLATES.append((f"CC-{_short}-3.0", f"This work is licensed under a Creative Commons {_long} 3.0 Unported License"))

#: Names and versions: where a template has one of these phrases, the text must have it too.
TELLING = ["Apache License", "MIT License", "BSD 3-Clause", "BSD 2-Clause", "Neither the name", "Mozilla Public License", "2.0",
           "Eclipse Public License", "v1.0", "public domain",
           *[f"GNU {long} Public License" for _, long, _ in _GNU], *[f"version {v}" for _, _, v in _GNU], "v2.0", "v3.0", "v2.1",
           *[f"CC {short} {v}" for short, _ in _CC for v in ("4.0", "3.0")],
           *[f"Commons {long} {v}" for _, long in _CC for v in ("4.0", "3.0")]]

_INDEXES: dict[int, Index] = {}


def template_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license string, text string")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate(_LOWER))


def winnow(hashes: list[int], window: int = WINDOW) -> list[int]:
    """Places of the kept hashes: the rightmost smallest one of each window."""
    kept = []
    for lo in range(max(1, len(hashes) - window + 1)):
        part = hashes[lo:lo + window]
        if part:
            at = lo + max(i for i, h in enumerate(part) if h == min(part))
            if not kept or kept[-1] != at:
                kept.append(at)
    return kept


def holds(seq: list[int], phrase: list[int]) -> bool:
    """Whether the words of the phrase stand in the sequence one after the other."""
    return any(seq[i:i + len(phrase)] == phrase for i in range(len(seq) - len(phrase) + 1))


def least(body: list[int]) -> float:
    """Words of a template that a find has to match."""
    return (MIN_SHORT if len(body) < SHORT else MIN_COVERAGE) * len(body)


class Index:
    """Word numbers, template word sequences and the inverted index of their kept runs."""

    def __init__(self, templates: list[tuple[str, str]]):
        import xxhash

        self.number: dict[str, int] = {}
        self.names, self.bodies = [], []
        self.places: dict[tuple[int, ...], list[tuple[int, int]]] = defaultdict(list)
        for name, text in templates:
            words = words_of(text)
            if not words:
                continue
            body = [self.number.setdefault(w, len(self.number) + 1) for w in words]
            k = min(GRAM, len(body))
            hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k])) for i in range(len(body) - k + 1)]
            for at in winnow(hashes):
                self.places[tuple(body[at:at + k])].append((len(self.names), at))
            self.names.append(name)
            self.bodies.append(body)
        self.grams = sorted({len(g) for g in self.places})
        phrases = [[self.number.get(w, -1) for w in words_of(p)] for p in TELLING]
        self.telling = [[p for p in phrases if holds(body, p)] for body in self.bodies]

    def candidates(self, seq: list[int]) -> dict[int, list[tuple[int, int]]]:
        """By template, the matches ``(place in the text, diagonal)`` in order."""
        found: dict[int, list[tuple[int, int]]] = defaultdict(list)
        run = 0
        for i, w in enumerate(seq):
            run = run + 1 if w else 0  # a run with a word of no template matches nothing
            for k in self.grams:
                if run >= k:
                    for t, at in self.places.get(tuple(seq[i - k + 1:i + 1]), ()):
                        found[t].append((i - k + 1, i - k + 1 - at))
        return found

    def find(self, seq: list[int]) -> list[tuple[int, int, int, int]]:
        """``(template, first word, last word + 1, matched words)`` of all finds, overlaps resolved."""
        out = []
        for t, matches in self.candidates(seq).items():
            body = self.bodies[t]
            groups: list[list[tuple[int, int]]] = []
            for place, diagonal in matches:
                g = groups[-1] if groups else None
                if g and place - g[0][0] <= len(body) + BAND and abs(diagonal - g[-1][1]) <= BAND:
                    g.append((place, diagonal))
                else:
                    groups.append([(place, diagonal)])
            for g in groups:
                out += [(t, *hit) for hit in stretches(body, seq, g) if all(holds(seq[hit[0]:hit[1]], p) for p in self.telling[t])]
        kept: list[tuple[int, int, int, int]] = []
        for t, a, b, m in sorted(out, key=lambda h: (-h[3], -h[3] / len(self.bodies[h[0]]), self.names[h[0]], h[1])):
            k = bisect(kept, a, key=lambda h: h[1])  # the finds kept so far do not overlap, so two neighbours tell
            if (k == 0 or kept[k - 1][2] <= a) and (k == len(kept) or b <= kept[k][1]):
                kept.insert(k, (t, a, b, m))
        return kept


def stretches(body: list[int], seq: list[int], group: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """All finds of a group: the best one, then those in what is left before and after it, as long as matches are there."""
    out, size = [], min(GRAM, len(body))
    todo = [(group, 0, len(seq))]
    while todo:
        part, lo, hi = todo.pop()
        if not part or hi - lo < least(body):
            continue
        hit = align(body, seq, min(d for _, d in part) - BAND, max(d for _, d in part) + BAND, lo, hi)
        if hit:
            if hit[2] >= least(body):
                out.append(hit)
            todo.append(([m for m in part if m[0] + size <= hit[0]], lo, hit[0]))
            todo.append(([m for m in part if m[0] >= hit[1]], hit[1], hi))
    return out


def align(body: list[int], seq: list[int], low: int, high: int, start: int = 0, end: int | None = None) -> tuple[int, int, int] | None:
    """Best local alignment of a template with the text's words ``start`` to ``end`` on diagonals ``low`` to ``high``: first
    and last + 1 word of the text, matched words. Rows are template words, columns the diagonals of the band."""
    end = len(seq) if end is None else end
    width = high - low + 1
    none = (0, 0, 0, 0)  # score, matched, first, last + 1
    above = [none] * (width + 2)
    best = none
    for i, w in enumerate(body):
        row = [none] * (width + 2)
        for c in range(1, width + 1):
            j = i + low + c - 1
            if not start <= j < end:
                continue
            s, m, a, b = above[c]
            if seq[j] == w:
                cell = (s + 1, m + 1, a if s else j, j + 1)
            else:
                cell = (s - 1, m, a, b)
            for s, m, a, b in (above[c + 1], row[c - 1]):  # a template word or a text word more
                if s - 1 > cell[0]:
                    cell = (s - 1, m, a, b)
            row[c] = cell if cell[0] > 0 else none
            if row[c][0] > best[0]:
                best = row[c]
        above = row
    return (best[2], best[3], best[1]) if best[0] else None


def _index(key: int, shared) -> Index:
    if key not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[key] = Index(shared.value)
    return _INDEXES[key]


_FIELD = T.ArrayType(T.StructType([T.StructField("license", T.StringType()), T.StructField("start", T.LongType()),
                                   T.StructField("end", T.LongType()), T.StructField("coverage", T.DoubleType())]))
_PA_FIELD = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())]))


def licenses(docs: DataFrame, templates: DataFrame, carry: dict[str, object]) -> DataFrame:
    """``carry`` columns plus ``finds``: license, span in code points and covered share of the template, by start."""
    prepare(docs.sparkSession)
    size = templates.agg(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
    if size > MAX_TEMPLATE_WORDS:
        raise ValueError(f"{size} template words; the index is built for {MAX_TEMPLATE_WORDS}")
    rows = [(r["license"], r["text"]) for r in templates.filter("license IS NOT NULL AND text IS NOT NULL")
            .select("license", "text").orderBy("license", "text").collect()]
    shared, key = docs.sparkSession.sparkContext.broadcast(rows), hash(tuple(rows))

    def of(texts: pa.Array) -> list[pa.Array]:
        index, out = _index(key, shared), []
        get = index.number.get
        for text in texts.to_pylist():
            low = text.translate(_LOWER) if not text.isascii() else text.lower()
            seq = [get(w, 0) for w in WORD.findall(low)]
            hits = index.find(seq)
            if hits:
                at = [(m.start(), m.end()) for m in WORD.finditer(low)]
                out.append([{"license": index.names[t], "start": at[a][0], "end": at[b - 1][1], "coverage": m / len(index.bodies[t])}
                            for t, a, b, m in hits])
            else:
                out.append([])
        return [pa.array(out, _PA_FIELD)]

    return map_texts(docs, of, [("finds", _FIELD)], carry)
