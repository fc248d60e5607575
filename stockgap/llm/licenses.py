"""License scan: winnowed fingerprints, inverted index, banded alignment.

Words are runs of ASCII letters and digits, in lower case.  Fingerprints are
hashed pairs of adjacent words; of every two neighbouring pairs the smaller
hash is kept (winnowing), so a text that shares three words in a row with a
template shares a fingerprint with it.  The fingerprints of the templates
form an inverted index, whose size is that of the templates.

A template becomes a candidate at a diagonal (document word minus template
word) where enough of its fingerprints meet; there the words are aligned
within a band (match +2, mismatch and gap -1, best local alignment).  What
covers at least ``COVERAGE`` of the template's words is reported with its
span.  A match inside the span of one with more matched words (or as many,
and a higher coverage) is not.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches, text_of

COVERAGE = 0.8
ENOUGH = 0.3  # of a template's fingerprints: words that miss 20 % of a template leave 40 % of its pairs of pairs
WORD = re.compile(r"[A-Za-z0-9]+")
_NONE = np.uint64(2**64 - 1)
_MATCH = "license string, coverage double, matched_words int, start int, end int, text string"

# fixed values: public license texts and notices
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MIT notice": "Released under the MIT License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "All rights reserved": "All rights reserved.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN
AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED
BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND
ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the
copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without
specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY,
OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this
software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product,
an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly
marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any
source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any
and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present
and future rights to this software under copyright law.""",
    "LGPL-3.0-or-later": """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have
received a copy of the GNU Lesser General Public License along with this library. If not, see https://www.gnu.org/licenses/.""",
    "AGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have
received a copy of the GNU Affero General Public License along with this program. If not, see https://www.gnu.org/licenses/.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations
under the License.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a
copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.""",
}


def _mix(x: np.ndarray) -> np.ndarray:
    """A spread of 64-bit codes, so that winnowing picks by chance."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Index:
    """Inverted index of the templates' winnowed fingerprints."""

    def __init__(self, templates: Mapping[str, str]):
        words = {name: [w.lower() for w in WORD.findall(text)] for name, text in templates.items()}
        words = {name: w for name, w in words.items() if len(w) > 1}
        self.names = list(words)
        self.vocabulary: dict[str, int] = {}
        for w in words.values():
            for x in w:
                self.vocabulary.setdefault(x, len(self.vocabulary))
        self.words = [np.array([self.vocabulary[x] for x in w], np.int64) for w in words.values()]
        posts = []
        self.n_prints = []
        for t, ids in enumerate(self.words):
            at, prints = self.winnow(ids)
            self.n_prints.append(len(at))
            posts += [(int(p), t, int(i)) for p, i in zip(prints, at)]
        posts.sort()
        self.prints = np.array([p[0] for p in posts], np.uint64)
        self.posts = np.array([p[1:] for p in posts], np.int64).reshape(-1, 2)

    def ids(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, map(str.lower, words), repeat(-1)), np.int64, len(words))

    def winnow(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, fingerprints) kept; pairs with foreign words never are."""
        if len(ids) < 2:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        known = (ids[:-1] >= 0) & (ids[1:] >= 0)
        h = np.where(known, _mix((ids[:-1] * len(self.vocabulary) + ids[1:] + 1).astype(np.uint64)), _NONE)
        keep = np.zeros(len(h), bool)
        left = h[:-1] < h[1:]
        keep[:-1] |= left
        keep[1:] |= ~left
        if len(h) == 1:
            keep[0] = True
        at = np.flatnonzero(keep & known)
        return at, h[at]

    def hits(self, ids: np.ndarray) -> np.ndarray:
        """(template, document word, template word) of each fingerprint met."""
        at, prints = self.winnow(ids)
        lo, hi = np.searchsorted(self.prints, prints, "left"), np.searchsorted(self.prints, prints, "right")
        n = hi - lo
        post = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.column_stack([self.posts[post, 0], np.repeat(at, n), self.posts[post, 1]])


def align(doc: np.ndarray, template: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """(matched words, first, last document word) of the best local alignment
    with |document word - template word - diagonal| <= band; (0, 0, 0): none."""
    width = 2 * band + 1
    score = np.zeros(width + 2, np.int64)
    best, end = 0, None
    steps = np.zeros((len(template) + 1, width + 2), np.int8)  # 1: pair, 2: skip template word, 3: skip document word
    for i, w in enumerate(template.tolist(), 1):
        new = np.zeros(width + 2, np.int64)
        first = i - 1 + diagonal - band  # the document word of column 1
        for c in range(1, width + 1):
            j = first + c - 1
            if not 0 <= j < len(doc):
                continue
            pair = score[c] + (2 if doc[j] == w else -1)
            up, left = score[c + 1] - 1, new[c - 1] - 1
            top = max(pair, up, left)
            if top > 0:
                new[c], steps[i, c] = top, 1 if top == pair else 2 if top == up else 3
                if top > best:
                    best, end = int(top), (i, c)
        score = new
    if end is None:
        return 0, 0, 0
    (i, c), matched, last, at = end, 0, None, 0
    while i > 0 and 1 <= c <= width and steps[i, c]:
        j, step = i - 1 + diagonal - band + c - 1, steps[i, c]
        if step == 1:
            if doc[j] == template[i - 1]:
                matched, at, last = matched + 1, j, j if last is None else last
            i -= 1
        elif step == 2:
            i, c = i - 1, c + 1
        else:
            c -= 1
    return matched, at, 0 if last is None else last


def matches(text: str, index: Index, coverage: float = COVERAGE) -> list[tuple[str, float, int, int, int, str]]:
    """(license, coverage, matched words, start, end, text) found in a text,
    by start; spans in code points, end exclusive."""
    ids = index.ids(WORD.findall(text))
    hits = index.hits(ids)
    found = []
    for t in np.unique(hits[:, 0]).tolist():
        own, size = hits[hits[:, 0] == t], len(index.words[t])
        need = max(1, int(np.ceil(ENOUGH * index.n_prints[t])))
        if len(own) < need:
            continue
        band = 4 + size // 8
        diagonal = own[:, 1] - own[:, 2]
        order = np.argsort(diagonal, kind="stable")
        d = diagonal[order]
        inside = np.searchsorted(d, d + band, "right") - np.arange(len(d))  # hits within a band from here on
        at = 0
        while at < len(d):  # neighbouring diagonals are one place
            if inside[at] < need:
                at += 1
                continue
            place = d[at: at + inside[at]]
            left = ids.copy()
            while (got := align(left, index.words[t], int(np.median(place)), band))[0] >= coverage * size:
                found.append((*got, t))
                left[got[1]: got[2] + 1] = -2  # the next repetition, if one follows at once
            at += int(inside[at])
    if not found:
        return []
    found.sort(key=lambda x: (-x[0], len(index.words[x[3]]), x[1], x[3]))
    kept: list[tuple[int, int, int, int]] = []
    for x in found:
        if not any(k[1] <= x[1] and x[2] <= k[2] for k in kept):
            kept.append(x)
    spans = [m.span() for m in WORD.finditer(text)]
    return [(index.names[t], n / len(index.words[t]), n, spans[i][0], spans[j][1], text[spans[i][0]: spans[j][1]])
            for n, i, j, t in sorted(kept, key=lambda x: (x[1], x[3]))]


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, license, coverage, matched_words, start, end, text): a row per
    match in the whole texts of ``docs``.

    Null and empty texts match nothing; a row without doc_id is scanned like
    any other; rows that repeat are each reported.
    """
    index = Index(templates)

    @F.pandas_udf(f"array<struct<{_MATCH.replace(' ', ':').replace(',:', ',')}>>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([matches(t, index, coverage) for t in texts], dtype=object)

    return text_batches(docs).select(docs["doc_id"].alias("doc_id"), found(text_of(docs["text"])).alias("m")).select(
        "doc_id", F.explode("m").alias("m")).select("doc_id", "m.*")
