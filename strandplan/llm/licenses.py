"""License scans: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies.

A template of T shingles (five words) belongs to the class whose step s, four times a power of two, is the least with
T <= 0.8 s.  In each class a text is cut into windows of 2 s shingles, moved by s, so a copy of the template lies whole in one.
Every window is signed with ``BANDS`` MinHash values of one row each; a table from band and value to templates
retrieves those that share a value with it.  A window that holds ``CONTAINMENT`` of a template has a Jaccard similarity J of
0.8 T / (2 s + 0.2 T) at least with it, which is 0.125 for one shingle in the smallest class and 0.15 and more in the others,
so the chance to miss it, (1 - J) ** BANDS, is below one in ten million.  What is retrieved is verified by exact containment,
and the shingles found tell one occurrence from the next.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import gram_hashes, mix, text_or_empty, word_bounds, word_hashes

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 128
LEAST_STEP = 4
TILE = 16384
"""Shingles of a text that are signed at once, or 16 steps of the largest class if that is more."""
_WORD = re.compile(r"[^\W_]+")

# Public licence texts and the notices that licences ask to be put on works.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
)
_BSD_OPENS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_BSD_LISTS = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_ENDS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GPL_REST = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
    "See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program."
)
NOTICES = {
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 '
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
    "See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": _BSD_OPENS + _BSD_LISTS + _BSD_ENDS,
    "BSD-3-Clause": _BSD_OPENS + _BSD_LISTS + _BSD_THIRD + _BSD_ENDS,
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, "
    "and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, "
    "and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. " + _GPL_REST,
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. " + _GPL_REST,
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0-notice": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
    "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS
    + "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MIT-notice": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. "
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}


def words_of(text: str) -> bytes:
    """Lower-cased runs of letters and digits, joined by spaces."""
    return " ".join(_WORD.findall(text.lower())).encode("utf-8", "surrogatepass")


def shingles_of(text: str) -> np.ndarray:
    """Hashes of all runs of five words; of fewer words the whole; of none none."""
    data = np.frombuffer(words_of(text), np.uint8)
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
    words = word_hashes(data, starts, ends)
    return gram_hashes(words, min(SHINGLE, len(words))) if len(words) else words


_SEEDS = (mix(np.arange(1, BANDS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_NONE = np.uint32(2**32 - 1)


def _signed(shingles: np.ndarray) -> np.ndarray:
    """BANDS hashes of each shingle, one row a shingle."""
    return (shingles >> np.uint64(32)).astype(np.uint32)[:, None] * _SEEDS[None, :]


def _in_band(values: np.ndarray) -> np.ndarray:
    """The values with the number of their band in the lowest bits."""
    return (values & ~np.uint32(BANDS - 1)) | np.arange(BANDS, dtype=np.uint32)


def _by_two(rows: np.ndarray) -> np.ndarray:
    """The lesser values of each two rows."""
    if len(rows) % 2:
        rows = np.concatenate([rows, np.full((1, BANDS), _NONE)])
    return np.minimum(rows[0::2], rows[1::2])


class Notices:
    """Band tables and shingle sets of the templates, by class."""

    def __init__(self, notices: dict[str, str], containment: float):
        self.containment = containment
        shingled = {name: s for name, text in sorted(notices.items()) if len(s := shingles_of(text or ""))}
        self.sets = {name: np.unique(s) for name, s in shingled.items()}
        self.uses = {name: Counter(s.tolist()) for name, s in shingled.items()}
        members: dict[int, list[str]] = {}
        for name, s in self.sets.items():
            step = LEAST_STEP
            while len(s) > 0.8 * step:
                step *= 2
            members.setdefault(step, []).append(name)
        self.tables = {}
        for step, names in members.items():
            values = np.concatenate([_in_band(_signed(self.sets[n]).min(axis=0)) for n in names])
            order = np.argsort(values, kind="stable")
            maybe = np.zeros(1 << 16, bool)
            maybe[values >> np.uint32(16)] = True
            self.tables[step] = (values[order], np.repeat(np.arange(len(names)), BANDS)[order], maybe, names)
        self.largest = max(self.tables, default=LEAST_STEP)

    def _retrieved(self, shingles: np.ndarray) -> Iterator[tuple[str, int, int]]:
        """Template, first and last + 1 shingle of the windows that share a band with it."""
        tile = max(TILE, 16 * self.largest)
        for t in range(0, len(shingles), tile):
            part = shingles[t : t + tile + self.largest]
            low, step = _by_two(_by_two(_signed(part))), LEAST_STEP
            while step <= self.largest:
                if step in self.tables:
                    values, owner, maybe, names = self.tables[step]
                    window = np.minimum(low, np.concatenate([low[1:], np.full((1, BANDS), _NONE)]))[: -(-min(tile, len(part)) // step)]
                    w, band = np.nonzero(maybe[window >> np.uint32(16)])
                    seen = _in_band(window)[w, band]
                    lo, hi = np.searchsorted(values, seen, "left"), np.searchsorted(values, seen, "right")
                    count = hi - lo
                    at = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    for k, j in sorted(set(zip(owner[at].tolist(), np.repeat(w, count).tolist(), strict=True))):
                        yield names[k], t + j * step, min(t + (j + 2) * step, len(shingles))
                low, step = _by_two(low), 2 * step

    def find(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """(template, shared shingles, its shingles, first word, word after the last) of every occurrence, by place."""
        shingles = shingles_of(text)
        if not len(shingles) or not self.tables:
            return []
        windows: dict[str, list[tuple[int, int]]] = {}
        for name, lo, hi in self._retrieved(shingles):
            windows.setdefault(name, []).append((lo, hi))
        words = SHINGLE if len(shingles) > 1 else min(SHINGLE, len(words_of(text).split()))
        found = []
        for name, spans in windows.items():
            template = self.sets[name]
            places = np.unique(np.concatenate([lo + np.flatnonzero(np.isin(shingles[lo:hi], template)) for lo, hi in spans]))
            uses, group = self.uses[name], []  # places of the occurrence that is being read
            had: Counter = Counter()
            for p in [*places.tolist(), -1]:
                key = int(shingles[p])
                if group and (p < 0 or had[key] == uses[key] or p - group[-1] > len(template)):
                    if len(had) >= self.containment * len(template) - 1e-9:
                        found.append((name, len(had), len(template), group[0], group[-1] + words))
                    group, had = [], Counter()
                group.append(p)
                had[key] += 1
        return sorted(found, key=lambda f: (f[3], f[0]))


def find_licenses(docs: DataFrame, notices: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, license_id, n_shared, n_shingles, word_start, word_end, fullest: every occurrence of a template in every text.

    An occurrence ends where a shingle of the template comes again or more than the template's length away.  fullest: no
    overlapping occurrence of another template holds a greater share of it (versions of a licence are near each other).
    Null and wordless texts hold none; a repeated row repeats its rows; a template without words is never found, one of fewer
    than five words only as a whole text; a row without doc_id is scanned like any other; an empty table or no templates: no
    rows.  Ties are told apart by name.  Other columns are ignored.  The templates are held in memory by every worker.
    """
    chosen = NOTICES if notices is None else notices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Notices(chosen, containment)
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = index.find(text.as_py())
                for name, shared, n, lo, hi in found:
                    fullest = not any(o[1] * n > shared * o[2] and o[3] < hi and lo < o[4] for o in found)
                    for column, v in zip(out, (doc, name, shared, n, lo, hi, fullest), strict=True):
                        column.append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["doc_id", "license_id", "n_shared", "n_shingles", "word_start", "word_end", "fullest"])

    schema = "doc_id long, license_id string, n_shared long, n_shingles long, word_start long, word_end long, fullest boolean"
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, schema)
