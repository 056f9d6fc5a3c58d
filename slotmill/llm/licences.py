"""Licence scan: Dice coefficient over word bigrams against licence templates.

A candidate is any run of words of a text. It is compared with the templates
whose size leaves the wanted coefficient possible: with n bigrams in the
template and m in the candidate, the coefficient is at most
2 min(n, m) / (n + m). Runs are only begun where enough bigrams of the template
follow.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from importlib.resources import files
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from slotmill.llm.common import table

LEAST_DICE = 0.8
#: a template of fewer bigrams is only met by a shorter run if that begins and ends a line or sentence
TRIMMED = 20



def _full(name: str) -> str:
    return files("slotmill.llm").joinpath("licence_texts", f"{name}.txt").read_text("utf-8")


def _header(what: str, name: str, version: str) -> str:
    """The notice that goes on top of a file under a licence of the GNU family."""
    name = f"GNU {name}General Public License"
    return (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by "
        f"the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This "
        f"{what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
        f"of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
    )


_COPY = " You should have received a copy of the GNU {}General Public License along with this {}. If not, see <https://www.gnu.org/licenses/>."
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. "
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

#: fixed values: short notices, headers and texts of public licences
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
        _full("Apache-2.0"),
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v3.0.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details.",
        _header("program", "", "3") + _COPY.format("", "program"),
        _full("GPL-3.0"),
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        _header("program", "", "2"),
        _header("program", "", "2") + " You should have received a copy of the GNU General Public License along with this program; if "
        "not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
        _full("GPL-2.0"),
    ),
    "LGPL-3.0": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        _header("library", "Lesser ", "3"),
        _header("library", "Lesser ", "3") + _COPY.format("Lesser ", "library"),
        _full("LGPL-3.0"),
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        _header("program", "Affero ", "3"),
        _header("program", "Affero ", "3") + _COPY.format("Affero ", "program"),
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        _full("MPL-2.0"),
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", _BSD_2 + _BSD_END),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", _BSD_2 + _BSD_3 + _BSD_END),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        _full("CC0-1.0"),
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial "
        "or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software "
        "dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the "
        "public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
        "relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "
        "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org>",
    ),
}

FOUND = "array<struct<licence:string,dice:double,start:int,end:int,unit:string>>"

_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
_STOP = re.compile(r"[.!?][^\w\s]*(?=\s|$)")
#: a notice names who holds the rights; that part differs from text to text
_HOLDER = re.compile(
    r"(?im)copyright[^\S\n]*(?:\(c\)|©)?[^\S\n]*\d{4}(?:[^\n.!?]|[.!?](?!\s|$))*?(?=[.!?](?:\s|$)|$|\b(?:licen[cs]|released|distributed|permission|this\b))"
)
_CLOSE = re.compile(r"[^\w\s]*")
_BLANK = re.compile(r"\n[^\S\n]*\n")
AMERICAN = {"licence": "license", "licenced": "licensed"}


def without_holders(lower: str) -> str:
    """Lower-case text with copyright statements, up to the sentence's end or the notice after it, as spaces."""
    return _HOLDER.sub(lambda m: " " * len(m[0]), lower) if "copyright" in lower else lower


def normal_words(text: str) -> list[str]:
    """Lower-case words without year and holder of copyright statements; British spelling becomes American."""
    return [AMERICAN.get(w, w) for w in _WORD.findall(without_holders(text.lower()))]


def bigrams(words: list[str]) -> Counter:
    return Counter(zip(words, words[1:]))


def dice(a: Counter, b: Counter) -> float:
    total = sum(a.values()) + sum(b.values())
    return 2 * sum((a & b).values()) / total if total else 0.0


class Scanner:
    """Templates by number of bigrams, and by the bigrams that they hold."""

    def __init__(self, templates: dict[str, tuple[str, ...]], least: float):
        self.least = least
        rows = sorted((sum(grams.values()), name, grams) for name, texts in templates.items() for t in texts if (grams := bigrams(normal_words(t))))
        self.sizes, self.rows = [n for n, _, _ in rows], rows
        self.known = {pair: i for i, pair in enumerate(sorted({p for _, _, grams in rows for p in grams}))}
        self.counts = np.zeros((len(self.known), len(rows)), np.int16)
        for number, (_, _, grams) in enumerate(rows):
            for pair, count in grams.items():
                self.counts[self.known[pair], number] = count
        self.holds = self.counts > 0
        # 2 shared / (n + m) >= least and m >= n least / (2 - least)
        self.needed = np.ceil(np.array(self.sizes) * least / (2 - least) - 1e-9)
        self.words = {w for _, _, grams in rows for pair in grams for w in pair}
        self.largest = int((self.sizes[-1] + 1) * (2 - least) / least) + 1 if rows else 0

    def _candidates(self, pairs: np.ndarray) -> list[int]:
        """Templates of whose bigrams the text has enough."""
        pairs = pairs[pairs >= 0]
        if not len(pairs):
            return []
        return np.flatnonzero(self.holds[pairs].sum(axis=0) >= self.needed).tolist()

    def best(self, words: list[str]) -> tuple[float, str] | None:
        """The template with the largest coefficient of at least ``least``; of equal ones the first name."""
        m = len(words) - 1
        if m < 1 or len(words) > self.largest:
            return None
        # a match shares m least / (2 - least) bigrams or more, each of which begins with a word of the templates
        if sum(map(self.words.__contains__, words)) < m * self.least / (2 - self.least):
            return None
        grams, best = bigrams(words), None
        # 2 min(n, m) / (n + m) >= least  <=>  m least / (2 - least) <= n <= m (2 - least) / least
        low, high = m * self.least / (2 - self.least), m * (2 - self.least) / self.least
        for n, name, template in self.rows[bisect_left(self.sizes, low - 1e-9) : bisect_right(self.sizes, high + 1e-9)]:
            value = 2 * sum((grams & template).values()) / (n + m)
            if value >= self.least and (best is None or value > best[0]):
                best = (value, name)
        return best

    def _windows(self, number: int, doc: Words, first: int, last: int) -> Iterator[tuple[float, int, int]]:
        """(dice, first word, last word) for each start between two words, its best run of words against a template."""
        n, name, grams = self.rows[number]
        low, high = ceil(n * self.least / (2 - self.least) - 1e-9), int(n * (2 - self.least) / self.least + 1e-9)
        pairs = doc.pairs[first:last]
        count = np.where(pairs >= 0, self.counts[pairs, number], 0)
        hit = count > 0
        held = np.concatenate([[0], np.cumsum(hit)])
        at = np.arange(len(pairs))
        possible = held[np.minimum(at + high, len(pairs))] - held[at] >= self.needed[number]
        if n >= TRIMMED:  # a run that begins without a hit is better without its first word
            possible &= hit
        if not possible.any():
            return
        # a hit counts in runs that begin after the occurrence which already used up the template's
        spent, seen = np.full(len(pairs), -1), {}
        for i in np.flatnonzero(hit).tolist():
            places = seen.setdefault(int(pairs[i]), [])
            places.append(i)
            if len(places) > count[i]:
                spent[i] = places[-1 - count[i]]
        # what the longest run from a start shares: a hit counts for the starts behind the occurrence that it would be too many with
        hits = np.flatnonzero(hit)
        turn = np.bincount(np.maximum(np.maximum(spent[hits], hits - high) + 1, 0), minlength=len(pairs) + 1)
        reach = np.cumsum(turn - np.bincount(hits + 1, minlength=len(pairs) + 1))[: len(pairs)]
        starts = np.flatnonzero(possible & (reach >= self.needed[number]))
        for a in starts.tolist():
            stop = min(a + high, len(pairs))
            shared = np.cumsum(hit[a:stop] & (spent[a:stop] < a))
            size = np.arange(1, stop - a + 1)
            value = np.where(size >= low, 2 * shared / (n + size), 0)
            if n < TRIMMED:
                # else the word that tells one licence from another could be left out
                ends = doc.ends[first + a + 1 : first + stop + 1] if doc.begins[first + a] else False
                value = np.where((size >= n) | ends, value, 0)
            best = int(value.argmax())
            if value[best] >= self.least - 1e-12:
                yield float(value[best]), first + a, first + a + best + 1

    def scan(self, text: str | None) -> list[dict]:
        """The licences of a text, by place. Of overlapping runs of words the better match stays, the longer of equal ones.

        All runs of words are looked at, over lines, sentences and blocks.
        """
        doc = Words(text or "", self.known)
        numbers = self._candidates(doc.pairs)
        if not len(numbers):
            return []
        doc.place()
        kept, open_parts = [], [(0, len(doc.pairs))]
        while open_parts:
            first, last = open_parts.pop()
            found = []
            for number in numbers:
                for value, a, b in self._windows(number, doc, first, last):
                    found.append((-value, a - b, a, b, self.rows[number][1]))
            taken = np.zeros(last - first + 1, bool)
            for value, _, a, b, name in sorted(found):
                if not taken[a - first : b - first + 1].any():
                    taken[a - first : b - first + 1] = True
                    kept.append({"licence": name, "dice": -value, **doc.unit(a, b)})
            if found:  # what lies between them may hold shorter runs
                edges = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]]).astype(np.int8)))
                open_parts += [(first + int(a), first + int(b) - 1) for a, b in zip(edges[::2], edges[1::2]) if b - a > 1]
        return sorted(kept, key=lambda k: k["start"])


class Words:
    """The words of a text as numbers of known bigrams (-1: not of a template), and where they stand."""

    def __init__(self, text: str, known: dict[tuple[str, str], int]):
        self.text = text
        lower = text.lower()
        if len(lower) != len(text):
            lower = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
        self.plain = without_holders(lower)
        words = [AMERICAN.get(w, w) for w in _WORD.findall(self.plain)]
        self.pairs = np.fromiter((known.get(p, -1) for p in zip(words, words[1:])), np.int64, max(0, len(words) - 1))

    def place(self) -> None:
        """Where words stand, and which of them begin and end a line or sentence."""
        self.spans = [m.span() for m in _WORD.finditer(self.plain)]
        gaps = [self.plain[a[1] : b[0]] for a, b in zip(self.spans, self.spans[1:])]
        parted = ["\n" in gap or _STOP.search(gap) is not None for gap in gaps]
        self.begins, self.ends = np.array([True, *parted]), np.array([*parted, True])

    def unit(self, a: int, b: int) -> dict:
        """Place and kind of the words from ``a`` to ``b``."""
        text, start, end = self.text, self.spans[a][0], self.spans[b][1]
        end += len(_CLOSE.match(text, end)[0])
        inside = text[start:end]
        if _BLANK.search(inside):
            kind = "text"
        elif "\n" in inside:
            kind = "block"
        else:
            before = a == 0 or "\n" in text[self.spans[a - 1][1] : start]
            after = b + 1 == len(self.spans) or "\n" in text[end : self.spans[b + 1][0]]
            kind = "line" if before and after else "sentence"
        return {"start": start, "end": end, "unit": kind}


def licence_column(text: Column, templates: dict[str, tuple[str, ...]] = TEMPLATES, least: float = LEAST_DICE) -> Column:
    @pandas_udf(FOUND)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(templates, least)
        for texts in batches:
            yield pd.Series([scanner.scan(t) for t in texts], dtype=object)

    return of(text.cast("string"))


def licences(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
    least: float = LEAST_DICE,
) -> DataFrame:
    """(id, licence, dice, start, end, unit): one row for each place of a document that is a licence.

    ``start`` and ``end`` count characters of the text. A null or empty text has none; repeated rows
    are each reported; a null id is kept. Other columns are not used. Without templates, or on an
    empty table, the result is empty.
    """
    found = F.explode(licence_column(F.col(text_col), templates, least)).alias("hit")
    return docs.select(F.col(id_col), found).select(F.col(id_col), "hit.*")


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences in all documents."""
    return licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
