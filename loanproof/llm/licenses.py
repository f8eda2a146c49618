"""Licence scans: normalised text against templates by the Dice coefficient of word bigrams.

Units of a text are all its word windows, over line ends too. A unit and a template of sizes a and
b (numbers of bigrams, repeats included) reach a coefficient t only if a lies between b t / (2 - t)
and b (2 - t) / t, and cutting bigrams that the template lacks from a unit's ends only raises the
coefficient. So windows begin and end at bigrams of the template, and a beginning is passed over
unless enough of them follow within the longest size. A window holds at least one bigram that no
template of another name has, if its template has one. Of overlapping windows the one that shares
most bigrams stays. One pass, no shuffle, nothing per document but its own words.

Defined cases: null and empty texts match nothing; ties go to the longer template, then by
name; repeated rows give repeated results; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import math
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from loanproof.llm.common import texts

THRESHOLD = 0.8
_TOKEN = regex.compile(r"[\p{L}\p{N}]+(?:\.[\p{N}]+)*")

#: Public licence notices, by SPDX name.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Apache-2.0", "This project is licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This project is licensed under the GNU General Public License, version 3."),
]

_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS"'
_MIT_END = (
    ", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
    "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_PARTS = {name: text for name, text in TEMPLATES if name in ("BSD-2-Clause", "ISC", "Unlicense")}
#: Whole licences whose first part stands above.
TEMPLATES += [
    ("MIT", f"{TEMPLATES[2][1]} {_AS_IS}{_MIT_END}"),
    (
        "BSD-2-Clause",
        _PARTS["BSD-2-Clause"] + " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
        "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
        "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
        "OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "ISC",
        f'{_PARTS["ISC"]} {_AS_IS} AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND '
        "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Unlicense",
        _PARTS["Unlicense"] + " Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this "
        "software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large "
        "and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and "
        f"future rights to this software under copyright law. {_AS_IS}{_MIT_END.replace(' OR COPYRIGHT HOLDERS', '')}",
    ),
]


def normal(text: str) -> list[str]:
    """Words in lower case, without punctuation."""
    return _TOKEN.findall(text.lower())


def bigrams(words: list[str]) -> Counter:
    return Counter(zip(words, words[1:]))


class Template(NamedTuple):
    size: int
    name: str
    grams: Counter


class Shelf:
    """Templates by size."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float = THRESHOLD):
        found = [(name, normal(text)) for name, text in templates]
        self.held = sorted((Template(len(w) - 1, name, bigrams(w)) for name, w in found if len(w) > 1), key=lambda t: (t.size, t.name))
        self.sizes = [t.size for t in self.held]
        self.heads = frozenset(g for t in self.held for g in t.grams)
        self.threshold = threshold
        names: dict[tuple[str, str], set[str]] = {}
        for template in self.held:
            for gram in template.grams:
                names.setdefault(gram, set()).add(template.name)
        self.own = frozenset(g for g, n in names.items() if len(n) == 1)

    def best(self, words: list[str]) -> tuple[float, int, str] | None:
        """(coefficient, size, name) of the most similar template that reaches the threshold."""
        size, t = len(words) - 1, self.threshold
        if size < 1:
            return None
        low, high = bisect_left(self.sizes, size * t / (2 - t) - 1e-9), bisect_right(self.sizes, size * (2 - t) / t + 1e-9)
        if low == high:
            return None
        grams = bigrams(words)
        found = None
        for template in self.held[low:high]:
            both = sum(min(n, grams[g]) for g, n in template.grams.items() if g in grams)
            score = 2 * both / (size + template.size)
            if score >= t - 1e-12 and (found is None or (score, template.size) > found[:2]):
                found = (score, template.size, template.name)
        return found

    def windows(self, template: Template, hits: list[tuple[int, tuple[str, str]]]) -> list[tuple[float, int, int, int]]:
        """(coefficient, shared bigrams, first bigram, last bigram) of the best window from each beginning that reaches the threshold."""
        m, t = template.size, self.threshold
        need, widest = math.ceil(m * t / (2 - t) - 1e-9), math.floor(m * (2 - t) / t + 1e-9)
        own = self.own.intersection(template.grams)
        inside = [hit for hit in hits if hit[1] in template.grams]
        found = []
        for a in range(len(inside) - need + 1):
            start = inside[a][0]
            if inside[a + need - 1][0] - start >= widest:
                continue
            held, both, named, best = Counter(), 0, not own, None
            for at, gram in itertools.islice(inside, a, None):
                if at - start >= widest:
                    break
                held[gram] += 1
                both += held[gram] <= template.grams[gram]
                named = named or gram in own
                score = 2 * both / (at - start + 1 + m)
                if named and score >= t - 1e-12 and (best is None or score > best[0]):
                    best = (score, both, start, at)
            if best:
                found.append(best)
        return found

    def scan(self, text: str) -> list[tuple[int, int, str, float]]:
        """(first line, last line, name, coefficient) of the windows that match, none over another."""
        hits, words, starts, numbers, before = [], 0, [], [], []
        for k, line in enumerate(text.split("\n")):
            tokens = normal(line)
            if not tokens:
                continue
            chain = before + tokens
            if not self.heads.isdisjoint(zip(chain, chain[1:])):
                base = words - len(before)
                hits.extend((base + n, gram) for n, gram in enumerate(zip(chain, chain[1:])) if gram in self.heads)
            starts.append(words)
            numbers.append(k)
            words += len(tokens)
            before = tokens[-1:]
        seen = {gram for _, gram in hits}
        every = []
        for template in self.held:
            if 1.001 * len(hits) < template.size * self.threshold / (2 - self.threshold) or seen.isdisjoint(template.grams):
                continue
            every.extend((w, template) for w in kept(self.windows(template, hits), words, lambda w: (-w[0], w[2])))
        rank = lambda x: (-x[0][1], -x[0][0], -x[1].size, x[0][2], x[1].name)
        found = kept([(*w, template) for w, template in every], words, lambda w: rank((w[:4], w[4])))
        line_of = lambda word: numbers[bisect_right(starts, word) - 1]
        return [(line_of(w[2]), line_of(w[3] + 1), w[4].name, w[0]) for w in sorted(found, key=lambda w: w[2])]


def kept(found: list[tuple], words: int, rank) -> list[tuple]:
    """Windows in the order of ``rank`` that do not overlap one before."""
    taken, out = bytearray(words if found else 0), []
    for w in sorted(found, key=rank):
        first, last = w[2], w[3] + 1
        if not any(taken[first : last + 1]):
            taken[first : last + 1] = b"\1" * (last + 1 - first)
            out.append(w)
    return out


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license (of the most similar unit, else null), dice, n_matches and spans name:first line:last line."""
    shelf = Shelf(TEMPLATES if templates is None else templates, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                found = shelf.scan(text)
                best = max(found, key=lambda m: (m[3], -m[0]), default=None)
                rows.append((best and best[2], best and best[3], len(found), ",".join(f"{m[2]}:{m[0]}:{m[1]}" for m in found)))
            columns = [batch.column("doc_id"), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "license", "dice", "n_matches", "spans"])

    return texts(docs).mapInArrow(run, "doc_id long, license string, dice double, n_matches long, spans string")
