"""License scans: passages compared with license templates by the Dice coefficient of word bigrams.

Texts and templates are normalised: lower case, words only.  With B the bigrams of a passage and T those
of a template, both counted with repeats, Dice = 2 |B and T| / (|B| + |T|).  A passage that reaches
``threshold`` has between |T| * t / (2 - t) and |T| * (2 - t) / t bigrams, so each template is
compared only with passages of these sizes, and only around places where enough of its bigrams stand:
every passage has to hold |T| * t / (2 - t) of them.  All passages that begin and end with a bigram of the
template are looked at, which holds the best one.  Of passages that overlap the best stays: higher
Dice, then more bigrams, then the smaller template id and place.

Null texts are empty texts; texts and templates of fewer than two words match nothing.  Rows are
scanned by themselves: repeated rows and ids stay, null ids are kept; empty tables give an empty table;
further columns are ignored.
"""

from __future__ import annotations

import bisect
import heapq
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, whole

THRESHOLD = 0.8
# Begins of passages that are compared at once; with the longest template this bounds the memory.
BEGINS = 256
CUT = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))

BSD_CONDITIONS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
BSD_ADVERTISING = "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the copyright holder."
BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_DISCLAIMER = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."


def _gnu_header(work: str, name: str, version: str) -> str:
    return f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version}, or (at your option) any later version. This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."


def _cc_sentence(kind: str) -> str:
    return f"This work is licensed under a Creative Commons {kind} 4.0 International License."


# License texts and the notices that stand for them.  Licenses that differ in a few words
# need a template each, or the scan finds the name of the sibling.
TEMPLATES: Mapping[str, str] = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nd-4.0-notice": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0-notice": "Licensed under CC BY-NC-ND 4.0.",
    "cc0-1.0-notice": "Licensed under CC0 1.0.",
    "cc0-1.0-statement": "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work.",
    "cc-by-4.0-sentence": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-sentence": _cc_sentence("Attribution-ShareAlike"),
    "cc-by-nd-4.0-sentence": _cc_sentence("Attribution-NoDerivatives"),
    "cc-by-nc-4.0-sentence": _cc_sentence("Attribution-NonCommercial"),
    "cc-by-nc-sa-4.0-sentence": _cc_sentence("Attribution-NonCommercial-ShareAlike"),
    "cc-by-nc-nd-4.0-sentence": _cc_sentence("Attribution-NonCommercial-NoDerivatives"),
    "gpl-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "gpl-1.0-header": _gnu_header("program", "General Public License", "1"),
    "gpl-2.0-header": _gnu_header("program", "General Public License", "2 of the License"),
    "lgpl-2.0-header": _gnu_header("library", "Library General Public License", "2 of the License"),
    "lgpl-2.1-header": _gnu_header("library", "Lesser General Public License", "2.1 of the License"),
    "lgpl-3.0-header": _gnu_header("library", "Lesser General Public License", "3 of the License"),
    "agpl-3.0-header": _gnu_header("program", "Affero General Public License", "3 of the License"),
    "lgpl-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "epl-1.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "epl-2.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "mit-notice": "Released under the MIT License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mit-0": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "0bsd": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "bsd-2-clause": f"{BSD_CONDITIONS} {BSD_DISCLAIMER}",
    "bsd-3-clause": f"{BSD_CONDITIONS} 3. {BSD_NAMES} {BSD_DISCLAIMER}",
    "bsd-4-clause": f"{BSD_CONDITIONS} 3. {BSD_ADVERTISING} 4. {BSD_NAMES} {BSD_DISCLAIMER}",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to http://unlicense.org/",
}


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(CUT).split()


@dataclass(frozen=True)
class Found:
    dice: float
    size: int
    template: str
    begin: int  # first word
    end: int  # behind the last word


@dataclass(frozen=True)
class Template:
    """A template's distinct bigrams, sorted, with their counts, and the sizes of passages that can reach the threshold."""

    name: str
    grams: np.ndarray
    counts: np.ndarray
    size: int
    least: int
    most: int


class Scanner:
    """Templates, prepared for the scan of many texts."""

    def __init__(self, templates: Mapping[str, str], threshold: float = THRESHOLD):
        self.threshold = threshold
        self.numbers: dict[bytes, int] = {}
        self.templates: list[Template] = []
        shrink = threshold / (2 - threshold)
        for name, text in sorted(templates.items()):
            ids = [self.numbers.setdefault(w, len(self.numbers)) for w in words_of(text)]
            grams = Counter(a << 32 | b for a, b in zip(ids, ids[1:], strict=False))
            if size := grams.total():
                least = max(1, -int(-(size * shrink - 1e-9) // 1))
                known = np.array(sorted(grams), np.int64)
                counts = np.array([grams[g] for g in known.tolist()], np.int64)
                self.templates.append(Template(name, known, counts, size, least, int(size / shrink + 1e-9)))
        self.known = np.unique(np.concatenate([np.empty(0, np.int64), *(t.grams for t in self.templates)]))
        self.members = [np.isin(self.known, t.grams) for t in self.templates]

    def scan(self, text: str) -> list[Found]:
        words = words_of(text)
        number = self.numbers.get
        ids = np.array([number(w, -1) for w in words], np.int64)
        if len(ids) < 2 or not len(self.known):
            return []
        grams = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] << 32 | ids[1:], -1)
        at = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
        places = np.flatnonzero(self.known[at] == grams)
        at = at[places]
        around = []
        for template, member in zip(self.templates, self.members, strict=True):
            if len(places) >= template.least and len(hits := places[member[at]]) >= template.least:
                around.append(Passages(template, hits, grams[hits], self.threshold))
        return _best(around)


class Passages:
    """The passages of a text that begin and end with a bigram of one template."""

    def __init__(self, template: Template, hits: np.ndarray, grams: np.ndarray, threshold: float):
        self.template, self.hits, self.threshold = template, hits, threshold
        # The n-th hit counts in a passage unless as many equal ones as the template has stand before it
        # there, so only if the passage begins behind the hit ``earlier[n]``.
        order = np.argsort(grams, kind="stable")
        ranked = grams[order]
        wanted = template.counts[np.searchsorted(template.grams, ranked)]
        back = np.arange(len(hits)) - wanted
        known = (back >= 0) & (ranked[np.maximum(back, 0)] == ranked)
        self.earlier = np.full(len(hits), -1, np.int64)
        self.earlier[order[known]] = order[back[known]]

    def first(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begins (as numbers of hits) of all passages that reach the threshold, with Dice and size of the best one."""
        stops = np.searchsorted(self.hits, self.hits + self.template.most)
        begins = np.flatnonzero(stops - np.arange(len(stops)) >= self.template.least)
        parts = [self.best(begins[i : i + BEGINS], stops[begins[i : i + BEGINS]]) for i in range(0, len(begins), BEGINS)]
        dice, size = (np.concatenate([np.empty(0, kind), *(p[n] for p in parts)]) for n, kind in enumerate((float, np.int64)))
        good = dice >= self.threshold
        return begins[good], dice[good], size[good]

    def before(self, begin: int, limit: int) -> tuple[float, int] | None:
        """Dice and size of the best passage from ``begin`` that ends at the word ``limit`` or earlier."""
        stop = int(np.searchsorted(self.hits, min(limit - 1, self.hits[begin] + self.template.most)))
        if stop - begin < self.template.least:
            return None
        dice, size = self.best(np.array([begin]), np.array([stop]))
        return (float(dice[0]), int(size[0])) if dice[0] >= self.threshold else None

    def best(self, begins: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The highest Dice from each begin to a hit before its stop, and the most bigrams that have it."""
        rows = begins[:, None]
        ends = rows + np.arange((stops - begins).max())
        inside = ends < stops[:, None]
        ends = np.minimum(ends, len(self.hits) - 1)
        common = np.cumsum(inside & (self.earlier[ends] < rows), axis=1)
        sizes = self.hits[ends] - self.hits[rows] + 1
        dice = np.where(inside & (sizes >= self.template.least), 2 * common / (sizes + self.template.size), 0.0)
        last = dice.shape[1] - 1 - np.argmax(dice[:, ::-1], axis=1)
        each = np.arange(len(begins))
        return dice[each, last], sizes[each, last]


def _best(around: list[Passages]) -> list[Found]:
    """The best of overlapping passages, in the order of the text.

    Each begin offers its best passage; when that one runs into a better passage behind it, the begin offers
    its best one that ends before.  So no text needs more than one offer for each template and bigram.
    """
    firsts = [p.first() for p in around]
    if not any(len(f[0]) for f in firsts):
        return []
    begin, dice, size = (np.concatenate(c) for c in zip(*firsts, strict=True))
    number = np.repeat(np.arange(len(around)), [len(f[0]) for f in firsts])
    order = np.lexsort((begin, number, -size, -dice))
    offers = ((-float(dice[k]), -int(size[k]), int(number[k]), int(begin[k])) for k in order)
    later: list[tuple[float, int, int, int]] = []
    taken: list[tuple[int, int]] = []
    out = []
    offer = next(offers, None)
    while offer or later:
        if later and (offer is None or later[0] < offer):
            one = heapq.heappop(later)
        else:
            one, offer = offer, next(offers, None)
        passages, n = around[one[2]], -one[1]
        start = int(passages.hits[one[3]])
        end = start + n + 1
        i = bisect.bisect_left(taken, (start, end))
        if i and taken[i - 1][1] > start:
            continue
        if i < len(taken) and taken[i][0] < end:
            if shorter := passages.before(one[3], taken[i][0]):
                heapq.heappush(later, (-shorter[0], -shorter[1], *one[2:]))
            continue
        taken.insert(i, (start, end))
        out.append(Found(-one[0], n, passages.template.name, start, end))
    return sorted(out, key=lambda f: f.begin)


def scanned(docs: DataFrame, id_column: str = "doc_id", text: str = "text", templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(id, license, first_word, n_words, dice) of every licensed passage of every row.

    The templates travel with the job; they are a parameter of the scan and not a growing table.
    """
    docs = docs.select(F.col(id_column), whole(text).alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    names = [id_column, "license", "first_word", "n_words", "dice"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, threshold)
        for batch in sliced(batches):
            at, found = [], []
            for i, t in enumerate(batch.column(1)):
                for one in scanner.scan(t.as_py()):
                    at.append(i)
                    found.append((one.template, one.begin, one.end - one.begin, one.dice))
            if at:
                types = [pa.string(), pa.int64(), pa.int64(), pa.float64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *columns], names=names)

    return docs.mapInArrow(run, f"`{id_column}` {kind}, license string, first_word long, n_words long, dice double")
