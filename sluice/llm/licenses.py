"""License scan by conditional compression.

1. Candidate blocks of a text with license cue words: every sentence (or
   line) with a cue, and windows of twice as many words as the longest
   template can reach, one reach apart, so that any notice around a cue lies
   whole in one of them, also one wrapped over lines or set in prose.
2. Each block is compressed alone and with every template as raw zstandard
   dictionary.  The templates are ranked by the bytes they save, then by the
   share of what they save on their own text.
3. The ranking is walked from the top until a template is confirmed by the
   exact differences in wording: words of the template that the block lacks,
   and words that stand between the first and last word it shares.  It is
   confirmed when no key word (name, version) is missing, and the words
   missing and those put in between are at most ``max_diff`` of it.  No rank
   ends the walk, so the ranking decides which template names a block and
   never whether one is found.
4. A block can hold several notices: the words before and after the winner
   are judged again as blocks of their own, until nothing is confirmed.

Overlapping confirmed blocks of a document keep the one that matches most
words (then the shorter, then the earlier).

Defined cases: null and empty texts have no blocks; every row is scanned by
itself, so repeated rows report alike; an empty table gives no rows; long
texts are scanned whole, in time linear in their words; other columns are
ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import ship_package

# Public license notices, as (license, key words, wording).
TEMPLATES = [
    ("Apache-2.0", "apache 2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "apache 2.0", "Licensed under the Apache License, Version 2.0 (the "
     "\"License\"); you may not use this file except in compliance with the License. You may "
     "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "mit", "Released under the MIT License."),
    ("MIT", "mit", "Licensed under the MIT License."),
    ("MIT", "permission granted", "Permission is hereby granted, free of charge, to any person "
     "obtaining a copy of this software and associated documentation files (the \"Software\"), "
     "to deal in the Software without restriction, including without limitation the rights to "
     "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so, subject to "
     "the following conditions:"),
    ("BSD-3-Clause", "bsd", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "redistribution", "Redistribution and use in source and binary forms, with "
     "or without modification, are permitted provided that the following conditions are met:"),
    ("GPL-2.0", "gnu general public license 2", "This work is licensed under the GNU General "
     "Public License, version 2."),
    ("GPL-3.0", "gnu general public license 3", "This work is licensed under the GNU General "
     "Public License, version 3."),
    ("GPL-3.0", "gnu general public license 3", "This program is free software: you can "
     "redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version."),
    ("LGPL-3.0", "gnu lesser general public license 3", "This work is licensed under the GNU "
     "Lesser General Public License, version 3."),
    ("AGPL-3.0", "gnu affero general public license 3", "This work is licensed under the GNU "
     "Affero General Public License, version 3."),
    ("MPL-2.0", "mozilla 2.0", "This Source Code Form is subject to the terms of the Mozilla "
     "Public License, v. 2.0."),
    ("ISC", "permission granted", "Permission to use, copy, modify, and/or distribute this "
     "software for any purpose with or without fee is hereby granted, provided that the above "
     "copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "cc by 4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "cc by-sa 4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "cc by-nc 4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "cc by-nd 4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "creative commons attribution 4.0", "This work is licensed under a Creative "
     "Commons Attribution 4.0 International License."),
    ("CC0-1.0", "cc0 1.0", "Released under CC0 1.0 Universal."),
    ("Unlicense", "public domain", "This is free and unencumbered software released into the "
     "public domain."),
    ("Apache-2.0", "license basis", "Unless required by applicable law or agreed to in writing, "
     "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
     "specific language governing permissions and limitations under the License."),
    ("MIT", "permission notice included", "The above copyright notice and this permission notice "
     "shall be included in all copies or substantial portions of the Software."),
    ("MIT", "warranty noninfringement", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
     "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
     "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
     "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
     "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
     "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-3-Clause", "neither endorse", "Neither the name of the copyright holder nor the names "
     "of its contributors may be used to endorse or promote products derived from this software "
     "without specific prior written permission."),
    ("GPL", "gnu general public license", "This program is distributed in the hope that it will "
     "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
     "or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
]
# License identifiers of the SPDX list that are told from tag lines.
TAGGED = """Apache-2.0 MIT ISC Unlicense BSD-2-Clause BSD-3-Clause MPL-2.0 EPL-2.0
    GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later
    LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later CC0-1.0 CC-BY-4.0
    CC-BY-SA-4.0""".split()
TEMPLATES += [(x, f"spdx-license-identifier {x.lower()}", f"SPDX-License-Identifier: {x}")
              for x in TAGGED]
# Short mentions: "the GNU General Public License v3" and its kin.
TEMPLATES += [(f"{x}-{v}.0", f"gnu{kind} general public license v{v}",
               f"the GNU{kind.title()} General Public License v{v}")
              for x, kind, v in (("GPL", "", 2), ("GPL", "", 3), ("LGPL", " lesser", 3),
                                 ("AGPL", " affero", 3))]
CUE = (r"(?i)licen[sc]e|copyright|permission|warrant|redistribut|public domain|spdx|"
       r"creative commons|\bcc[ -]by|\bcc0\b")
_CUE = re.compile(CUE)
_SENTENCE = re.compile(r"[^\n]+?(?:(?<=[.!?:;])(?=\s)|(?=\n)|$)")
_WORD = re.compile(r"[A-Za-z0-9]+(?:[.'-][A-Za-z0-9]+)*")
MAX_DIFF = 0.2

BLOCKS = ("doc_id long, block int, license string, template int, start long, end long, "
          "size_alone int, size_given int, saved double, n_shared int, missing string, "
          "added string, exact boolean")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


@dataclass(frozen=True)
class Found:
    license: str
    template: int
    start: int
    end: int
    size_alone: int
    size_given: int
    saved: float
    n_shared: int
    missing: str
    added: str


def _shared(template: list[str], block: list[str]) -> list[tuple[int, int]]:
    """A longest common subsequence of the words that ends as early as it can."""
    n, m = len(template), len(block)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(m - 1, -1, -1):
            row[j] = (below[j + 1] + 1 if template[i] == block[j]
                      else max(below[j], row[j + 1]))
    i = j = 0
    out = []
    while i < n and j < m and best[i][j]:
        if template[i] == block[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] == best[i][j]:
            i += 1
        else:
            j += 1
    return out


def word_diff(template: list[str], block: list[str]) -> tuple[list[str], list[str], list[int]]:
    """Missing words, words put in between, and the places of the shared
    words, taken where they stand closest."""
    first = _shared(template, block)
    if not first:
        return list(template), [], []
    end = first[-1][1] + 1  # then backwards from there, to start as late as possible
    back = _shared(template[::-1], block[:end][::-1])
    pairs = [(len(template) - 1 - i, end - 1 - j) for i, j in back][::-1]
    has, at = {i for i, _ in pairs}, [j for _, j in pairs]
    missing = [w for i, w in enumerate(template) if i not in has]
    used = set(at)
    return missing, [block[k] for k in range(at[0], at[-1]) if k not in used], at


class Scanner:
    """Templates with their compressors; built once per task."""

    def __init__(self, templates=TEMPLATES, max_diff: float = MAX_DIFF):
        import zstandard

        self.templates, self.max_diff = templates, max_diff
        self.alone = zstandard.ZstdCompressor(level=9, write_content_size=False)
        self.given, self.own, self.words = [], [], []
        for _, _, wording in templates:
            raw = self.form(wording)
            held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=9)
            given = zstandard.ZstdCompressor(write_content_size=False, dict_data=held)
            self.given.append(given)
            self.own.append(max(1, len(self.alone.compress(raw)) - len(given.compress(raw))))
            self.words.append(words_of(wording))
        self.sets = [set(w) for w in self.words]
        self.keys = [set(k.split()) for _, k, _ in templates]
        self.reach = int(max(map(len, self.words)) * (1 + max_diff)) + 1

    @staticmethod
    def form(text: str) -> bytes:
        return " ".join(text.lower().split()).encode("utf-8", "surrogatepass")

    def rank(self, block: str) -> list[tuple[int, float, int, int, int]]:
        """All templates, the largest size reduction first: (bytes saved, their
        share of what the template saves on itself, -index, sizes)."""
        raw = self.form(block)
        size = len(self.alone.compress(raw))
        sizes = [len(c.compress(raw)) for c in self.given]
        return sorted(((size - z, (size - z) / own, -k, size, z)
                       for k, (z, own) in enumerate(zip(sizes, self.own))), reverse=True)

    def confirm(self, k: int, words: list[str], present: set[str]):
        """The wording differences of template ``k``, None beyond the bounds."""
        most = self.max_diff * len(self.words[k])
        if not self.keys[k] <= present or len(self.sets[k] - present) > most:
            return None  # at least these words are missing
        missing, added, at = word_diff(self.words[k], words)
        if len(missing) > most or len(added) > most or self.keys[k] & set(missing):
            return None
        return missing, added, at

    def winner(self, text: str, spans: list[tuple[int, int]]) -> Found | None:
        """The best ranked template that the block's wording confirms."""
        words = [text[a:b].lower() for a, b in spans]
        present = set(words)
        for _, share, k, size, given in self.rank(text[spans[0][0]:spans[-1][1]]):
            diff = self.confirm(-k, words, present)
            if diff:
                missing, added, at = diff
                return Found(self.templates[-k][0], -k, spans[at[0]][0], spans[at[-1]][1], size,
                             given, share, len(at), " ".join(missing), " ".join(added))
        return None

    def judge(self, text: str, spans: list[tuple[int, int]]) -> list[Found]:
        """The winner of a block, given by its words' places, and those of
        what it leaves before and after it."""
        out: list[Found] = []
        todo = [spans]
        while todo:
            spans = todo.pop()
            best = self.winner(text, spans) if spans else None
            if best:
                out.append(best)
                todo += [[x for x in spans if x[1] <= best.start],
                         [x for x in spans if x[0] >= best.end]]
        return out

    @staticmethod
    def order(f: Found) -> tuple:
        return -f.n_shared, f.end - f.start, f.start, f.template, f.size_alone

    def blocks(self, text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Candidate blocks as ranges of the text's words."""
        starts = [a for a, _ in spans]
        units = [m.span() for m in _SENTENCE.finditer(text)]
        unit_starts = [a for a, _ in units]
        out: dict[tuple[int, int], None] = {}
        for m in _CUE.finditer(text):
            i = max(0, bisect_right(starts, m.start()) - 1)
            a, b = units[max(0, bisect_right(unit_starts, m.start()) - 1)]
            lo, hi = bisect_left(starts, a), bisect_left(starts, b)
            if hi - lo <= 2 * self.reach:  # a longer one is read by the windows
                out[lo, hi] = None
            # a span of at most `reach` words that holds word i starts in one of two steps
            for step in {max(0, i - self.reach) // self.reach, i // self.reach}:
                out[step * self.reach, min(len(spans), (step + 2) * self.reach)] = None
        return [(lo, hi) for lo, hi in out if lo < hi]

    def scan(self, text: str | None) -> list[Found]:
        text = text or ""
        spans = [m.span() for m in _WORD.finditer(text)]
        found = [f for lo, hi in self.blocks(text, spans) for f in self.judge(text, spans[lo:hi])]
        kept: list[Found] = []
        for f in sorted(set(found), key=self.order):
            if all(f.end <= k.start or f.start >= k.end for k in kept):
                kept.append(f)
        return sorted(kept, key=lambda f: f.start)


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  templates=TEMPLATES, max_diff: float = MAX_DIFF) -> DataFrame:
    """One row per confirmed block, in the order of the text."""
    ship_package(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(templates, max_diff)
        names = [c.split()[0] for c in BLOCKS.split(", ")]
        for f in frames:
            rows = []
            for i, t in zip(f["doc_id"], f["text"]):
                for k, x in enumerate(scanner.scan(t)):
                    rows.append((i, k, x.license, x.template, x.start, x.end, x.size_alone,
                                 x.size_given, x.saved, x.n_shared, x.missing, x.added,
                                 not x.missing and not x.added))
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")) \
        .filter(F.col("text").rlike(CUE)).mapInPandas(run, BLOCKS)
