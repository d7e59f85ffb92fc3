"""Licence notices in texts, by the Dice coefficient of word bigrams against templates.

Compared are a text's lines, its paragraphs, the whole of it, and every run of as many words as a template has. Words are compared as 64-bit hashes. With a bigrams here and b in a
template, a coefficient of t needs t / (2 - t) * a <= b <= (2 - t) / t * a, and as large a share of the passage's bigrams must occur in
templates at all. Both bounds are checked with array arithmetic; only passages that pass are counted out.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words

THRESHOLD = 0.8

# Whole permission texts with their disclaimers; numbers of list items are left out.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
    "met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission.",
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
    'above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
    "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
    "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
    "SOFTWARE."
)

# Short notices and permission texts of common licences, by SPDX identifier.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either '
        "express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", _MIT),
    ("BSD-2-Clause", f"{_BSD[0]} {_BSD[2]}"),
    ("BSD-3-Clause", f"{_BSD[0]} {_BSD[1]} {_BSD[2]}"),
    ("ISC", _ISC),
)

_KIND = "struct<licence:string, dice:double, n_passages:long, passage:string>"


def _bigrams(hashes: np.ndarray) -> Counter[int]:
    return Counter(words.shingles(hashes, 2).tolist())


class Templates:
    def __init__(self, templates: tuple[tuple[str, str], ...], threshold: float):
        self.threshold = threshold
        _, _, _, hashes, rows = words.row_words(pa.array([t for _, t in templates], pa.string()), words.ALPHANUMERIC)
        self.all = [(name, _bigrams(hashes[a:b])) for (name, _), a, b in zip(templates, rows[:-1], rows[1:], strict=True)]
        self.known = np.array(sorted({b for _, bag in self.all for b in bag}), np.uint64)
        self.sizes = [bag.total() for _, bag in self.all]
        self.reach = threshold / (2 - threshold)

    def matches(self, bigrams: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, bigrams), len(self.known) - 1)
        return self.known[at] == bigrams

    def best(self, hashes: np.ndarray) -> tuple[float, str] | None:
        """The closest template of a passage, of equal ones the first by name, if it reaches the threshold."""
        bag, n, found = _bigrams(hashes), len(hashes) - 1, None
        for (name, other), size in zip(self.all, self.sizes, strict=True):
            if self.reach * n <= size <= n / self.reach:
                dice = 2 * sum(min(c, other[b]) for b, c in bag.items() if b in other) / (n + size)
                if dice >= self.threshold and (found is None or (-dice, name) < (-found[0], found[1])):
                    found = dice, name
        return found


    def windows(self, grams: np.ndarray, hit: np.ndarray, ends: np.ndarray) -> list[tuple[float, str, int, int]]:
        """Of every stretch of overlapping runs close to a template of their size, the closest: coefficient, name and word range.

        ``ends`` is the end of the row of each word, ``hit`` counts the bigrams before a place that occur in templates.
        """
        out = []
        for (name, other), size in zip(self.all, self.sizes, strict=True):
            least = self.threshold * size
            starts = np.flatnonzero(hit[size:] - hit[:-size] >= least) if 0 < size < len(hit) else np.zeros(0, np.int64)
            starts = starts[starts + size < ends[starts]]
            best: tuple[float, str, int, int] | None = None
            bag, common, last = Counter(), 0, -1
            for a in starts.tolist():
                if best and a > best[2] + size:
                    out.append(best)
                    best = None
                if a == last + 1 and last >= 0:
                    old, new = int(grams[last]), int(grams[last + size])
                    common -= bag[old] <= other[old]
                    bag[old] -= 1
                    bag[new] += 1
                    common += bag[new] <= other[new]
                else:
                    bag = Counter(grams[a : a + size].tolist())
                    common = (bag & other).total()
                last = a
                if common >= least and (best is None or common / size > best[0]):
                    best = common / size, name, a, a + size + 1
            if best:
                out.append(best)
        return out


def _passages(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word ranges of all lines, paragraphs and texts of a block."""
    breaks = np.flatnonzero(raw == 10)
    # Number of line breaks between a word and the one before it decides what begins with the word.
    gap = np.diff(np.searchsorted(breaks, starts), prepend=0) if len(starts) else np.zeros(0, np.int64)
    first = np.zeros(len(starts) + 1, bool)
    first[rows[rows < len(starts)]] = True
    first[-1] = True
    # A paragraph ends at a line without words: two breaks or more.
    bounds = [np.flatnonzero(first | np.append(gap >= k, True)) for k in (1, 2)] + [np.flatnonzero(first)]
    pairs = np.concatenate([np.stack([b[:-1], b[1:]], 1) for b in bounds]) if len(starts) else np.zeros((0, 2), np.int64)
    pairs = np.unique(pairs, axis=0)
    return pairs[:, 0], pairs[:, 1]


def licence_of(text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """``struct<licence, dice, n_passages, passage>`` of a text column: the best match, its text, and how many passages match one."""
    made: list[Templates] = []

    @F.arrow_udf(_KIND)
    def scan(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Templates(templates, threshold))
        known, out = made[0], []
        shortest = min(known.sizes, default=0) * known.reach
        for begin, end in words.blocks(texts):
            raw, starts, ends, hashes, rows = words.row_words(texts.slice(begin, end - begin), words.ALPHANUMERIC)
            a, b = _passages(raw, starts, ends, rows)
            grams = words.shingles(hashes, 2)
            hit = np.concatenate(([0], np.cumsum(known.matches(grams) if len(grams) else [])))
            n = b - a - 1
            ok = (n > 0) & (n >= shortest)
            likely = np.flatnonzero(ok)
            likely = likely[hit[b[likely] - 1] - hit[a[likely]] >= known.reach * n[likely]]
            found: list[list[tuple[float, str, int, int]]] = [[] for _ in range(end - begin)]
            for k in likely.tolist():
                if best := known.best(hashes[a[k] : b[k]]):
                    row = int(np.searchsorted(rows, a[k], "right")) - 1
                    found[row].append((-best[0], best[1], int(a[k]), int(b[k])))
            passages = [[m[2:] for m in matches] for matches in found]
            runs = known.windows(grams, hit, np.repeat(rows[1:], np.diff(rows)))
            # The run with the most bigrams of a template comes first; what overlaps it or a passage is the same notice.
            for dice, name, x, y in sorted(runs, key=lambda m: (-m[0] * (m[3] - m[2] - 1), -m[0], m[1], m[2])):
                row = int(np.searchsorted(rows, x, "right")) - 1
                if all(y <= p or q <= x for p, q in passages[row]):
                    passages[row].append((x, y))
                    found[row].append((-dice, name, x, y))
            for matches in found:
                if matches:
                    dice, name, x, y = min(matches)
                    passage = raw[starts[x] : ends[y - 1]].tobytes().decode()
                    out.append({"licence": name, "dice": -dice, "n_passages": len(matches), "passage": passage})
                else:
                    out.append({"licence": None, "dice": 0.0, "n_passages": 0, "passage": None})
        kind = pa.struct([("licence", pa.string()), ("dice", pa.float64()), ("n_passages", pa.int64()), ("passage", pa.string())])
        return pa.array(out, kind)

    return scan(text)


def scan_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, licence, dice, n_passages, passage`` for every row of ``docs`` (doc_id, text, any others).

    One scan and no shuffle; the templates are a fixed table that travels with the function. A text that is null, empty or close to no
    template has a null licence and passage, 0 for the coefficient and the count. Repeated rows are scanned each.
    """
    return docs.select("doc_id", licence_of().alias("l")).select("doc_id", "l.*")
