"""Licence texts in documents, by patience alignment.

A template is a list of words. Words that stand once in the text and once in the template are anchors; the longest
run of anchors that ascends in both, found by patience sorting, is kept, and the gaps between kept anchors are
aligned in the same way. Coverage is the part of the template's words that are aligned. A match may be anywhere
in a text, so the text is first cut to the stretches that can hold one: of every window of the template's length,
some with enough words of the template.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.words import Words, slices

# Notices by which texts name their licence, and short licence texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "BSD-3-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written permission."
    ),
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        'with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS '
        "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "Zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution."
    ),
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. You should have received a copy of the GNU General Public License along with this "
        "program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
}
#: Hundredths of a template's words that must be aligned.
PERCENT = 90
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_EDGE = b".,;:()\"'"


def template_words(text: str) -> list[bytes]:
    return [plain(w) for w in _WORD.findall(text.encode().lower())]


def plain(word: bytes) -> bytes:
    """A word in lower case without punctuation at its ends, unless nothing else is left."""
    return word.strip(_EDGE) or word


def ascending(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, given by ascending first number, whose second numbers ascend (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    before: list[int] = []
    for k, (_, y) in enumerate(pairs):
        at = bisect.bisect_left(tops, y)
        before.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(y)
            piles.append(k)
        else:
            tops[at], piles[at] = y, k
    out = []
    k = piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def align(x: list[bytes], y: list[bytes]) -> list[tuple[int, int]]:
    """Pairs of places of equal words of two lists, ascending in both."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and x[a] == y[c]:  # equal beginnings and ends need no anchor
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and x[b - 1] == y[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        in_x, in_y = Counter(x[a:b]), Counter(y[c:d])
        place = {w: k for k, w in enumerate(y[c:d], c) if in_y[w] == 1}
        anchors = ascending([(k, place[w]) for k, w in enumerate(x[a:b], a) if in_x[w] == 1 and w in place])
        found += anchors
        if anchors:
            ends = [(a - 1, c - 1), *anchors, (b, d)]
            todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(ends, ends[1:])]
    return sorted(found)


def stretches(known: np.ndarray, length: int, least: int) -> Iterator[tuple[int, int]]:
    """Stretches of a text that can hold a template: joined windows twice its length with enough of its words.

    ``known`` holds the places of words of the template, ascending.
    """
    if len(known) < least:
        return
    near = known[least - 1 :] - known[: len(known) - least + 1] < 2 * length
    first = last = -1
    for k in np.flatnonzero(near):
        a, b = int(known[k]), int(known[k + least - 1]) + 1
        if first >= 0 and a <= last:
            last = b
        else:
            if first >= 0:
                yield first, last
            first, last = a, b
    if first >= 0:
        yield first, last


class Scanner:
    def __init__(self, templates: dict[str, str], percent: int):
        self.templates = [(name, template_words(text)) for name, text in templates.items()]
        self.percent = percent

    def scan(self, words: list[bytes]) -> list[tuple[str, int, int, int, int]]:
        """(template, matched words, words of it, first word, end) of the matches in a text's words.

        Of matches that share words the longest one counts, then the one that covers more.
        """
        places: dict[bytes, list[int]] = {}
        for k, w in enumerate(words):
            places.setdefault(w, []).append(k)
        found = []
        for name, own in self.templates:
            least = -(-self.percent * len(own) // 100)
            some = Counter(own)
            if sum(min(n, len(places.get(w, ()))) for w, n in some.items()) < least:
                continue
            known = np.array(sorted(k for w in some for k in places.get(w, ())), np.int64)
            for a, b in stretches(known, len(own), least):
                at = a
                while b - at >= least:  # one match after another
                    pairs = self._first(words, own, at, b, least)
                    if pairs is None:
                        break
                    found.append((name, len(pairs), len(own), pairs[0][0], pairs[-1][0] + 1))
                    at = pairs[-1][0] + 1
        found.sort(key=lambda m: (-m[1], -m[1] / m[2], m[3], m[0]))
        kept: list[tuple[str, int, int, int, int]] = []
        for m in found:
            if all(m[4] <= k[3] or m[3] >= k[4] for k in kept):
                kept.append(m)
        return sorted(kept, key=lambda m: m[3])

    @staticmethod
    def _first(words: list[bytes], own: list[bytes], a: int, b: int, least: int) -> list[tuple[int, int]] | None:
        """Alignment of the first window that covers enough of the template."""
        vocabulary = set(own)
        width = 2 * len(own)
        for at in range(a, b - least + 1):
            if words[at] not in vocabulary:
                continue
            pairs = align(words[at : min(b, at + width)], own)
            if len(pairs) >= least and pairs[0][0] == 0:
                return [(at + x, y) for x, y in pairs]
        return None


def scan_licenses(
    docs: DataFrame, id: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None,
    percent: int = PERCENT,
) -> DataFrame:
    """(id, license, matched, n_template, first_word, end_word): a row for every licence match in every text.

    Words are parted by white space, in ASCII lower case, without punctuation at their ends. A match begins with an
    aligned word and aligns at least ``percent`` hundredths of the template within twice its length.

    Defined cases. Null texts and texts without words have no rows. Rows are scanned one by one, so repeated rows
    repeat theirs, and ids may be null. Templates without words are left out. An empty table gives an empty result.
    Other columns are not read.
    """
    scanner = Scanner({k: v for k, v in (templates or TEMPLATES).items() if v.split()}, percent)
    kind = docs.schema[id].dataType.simpleString()
    needed = [(set(own), -(-percent * len(own) // 100)) for _, own in scanner.templates]
    # a word of each template that few texts have: without enough of its words there is no match
    every = {w for own, _ in needed for w in own}
    names = [id, "license", "matched", "n_template", "first_word", "end_word"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Words(pa.array([w.decode() for w in sorted(every)])).hashes()
        for part in slices(batches, "text"):
            # texts that have some words of a template at all, told on whole batches
            bare = Words(pa.array([b" ".join(plain(w) for w in _WORD.findall((t or "").encode().lower()))
                                   for t in part.column(1).to_pylist()], pa.large_binary()))
            known = np.isin(bare.hashes(), vocabulary)
            hits = np.add.reduceat(np.append(known, False), bare.first[:-1]) if len(known) else np.zeros(part.num_rows)
            hits = np.where(bare.counts() > 0, hits, 0)
            out: list[list] = [[] for _ in names]
            for k in np.flatnonzero(hits >= min(least for _, least in needed)).tolist():
                a, b = bare.first[k], bare.first[k + 1]
                words = [bare.data[x:y].tobytes() for x, y in zip(bare.start[a:b], bare.end[a:b])]
                for match in scanner.scan(words):
                    for column, value in zip(out, (k, *match)):
                        column.append(value)
            columns = [part.column(0).take(pa.array(out[0], pa.int32())), pa.array(out[1], pa.string())]
            columns += [pa.array(c, pa.int64()) for c in out[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id}` {kind}, license string, matched long, n_template long, first_word long, end_word long"
    return docs.select(F.col(id), F.col(text).alias("text")).mapInArrow(rows, schema)
