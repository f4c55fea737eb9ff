"""License scans: TF-IDF cosine of license notices to templates, then inheritance from the nearest ancestor directory.

Every window of consecutive lines of every file (one line up to twice the longest template's words, and license files from their first
line on to any length) is compared with every template by the cosine of sparse TF-IDF vectors; words that no template has count in
a window's length with the weight of the rarest. Document counts are of lines over all files. A window matches a template only if both
have the same words of version and variant (VARIANTS: affero, sharealike, 3 ...), so a license is never given the name of its
relative. The best match over a threshold is the file's own license. A file named as a license file states the license of its directory; files
without a license of their own take that of the nearest ancestor directory that has one, found by joining the ancestors of
the distinct directories (not of the files) with the directories that have a license, then the files with their directory.

Texts are skipped without looking at windows only where no window can match: where they have none of the words that any match needs.

Defined cases: null or empty text has no line and no own license; null path is the root's; ties between templates go by name,
between license files of one directory by cosine, license, path; the opening that all BSD licenses share is named BSD; repeated rows
give their rows each; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cached_property
from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import BROADCAST_ROWS, map_arrow, save, strings

# Notices of public licenses.
_BSD_OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TWO = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THIRD = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_MIT_END = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
_GPL_SHORT = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation, either version {version} of the License."
_CC = "This work is licensed under a Creative Commons Attribution{kind} {version} International License."


def _gnu(kind: str, version: str, date: str, spdx: str) -> tuple[str, ...]:
    notices = (_GPL.format(kind=kind, version=version), _GPL_SHORT.format(kind=kind, version=version), f"This work is licensed under the GNU {kind}, version {version}.")
    return (*notices, f"GNU {kind} Version {version}, {date}", f"SPDX-License-Identifier: {spdx}", f"SPDX-License-Identifier: {spdx}-or-later", f"SPDX-License-Identifier: {spdx}-only")


def _cc(kind: str, short: str) -> tuple[str, ...]:
    return (_CC.format(kind=kind, version="4.0"), f"Licensed under CC {short} 4.0.", f"SPDX-License-Identifier: CC-{short}-4.0")


TEMPLATES = {
    "AGPL-3.0": _gnu("Affero General Public License", "3", "19 November 2007", "AGPL-3.0"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD": (_BSD_OPENING, "Released under a BSD license."),
    "BSD-2-Clause": (f"{_BSD_OPENING} {_BSD_TWO} {_BSD_END}", "Released under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"),
    "BSD-3-Clause": (f"{_BSD_OPENING} {_BSD_TWO} {_BSD_THIRD} {_BSD_END}", "Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"),
    "CC-BY-4.0": _cc("", "BY"),
    "CC-BY-NC-4.0": _cc("-NonCommercial", "BY-NC"),
    "CC-BY-ND-4.0": _cc("-NoDerivatives", "BY-ND"),
    "CC-BY-SA-4.0": _cc("-ShareAlike", "BY-SA"),
    "CC0-1.0": ("This work is released under CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0"),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.", "SPDX-License-Identifier: EPL-2.0"),
    "GPL-2.0": _gnu("General Public License", "2", "June 1991", "GPL-2.0"),
    "GPL-3.0": _gnu("General Public License", "3", "29 June 2007", "GPL-3.0"),
    "ISC": (_ISC, "Released under the ISC License.", "SPDX-License-Identifier: ISC"),
    "LGPL-2.1": _gnu("Lesser General Public License", "2.1", "February 1999", "LGPL-2.1"),
    "LGPL-3.0": _gnu("Lesser General Public License", "3", "29 June 2007", "LGPL-3.0"),
    "MIT": (f"{_MIT_GRANT} {_MIT_END}", _MIT_GRANT, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.", "Released under the MIT License.", "SPDX-License-Identifier: MIT"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "Mozilla Public License Version 2.0", "SPDX-License-Identifier: MPL-2.0"),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"),
}
#: Words of which a window and its template must have the same. Versions count without a final .0.
VARIANTS = frozenset("affero lesser library sharealike sa noncommercial nc noderivatives nd cc0 neither endorse 1 1.1 2 2.1 3 4".split())
THRESHOLD = 0.75
#: Cosine from which a template is met in full: of such ones the longest names the license, since short ones are parts of others.
FULL = 0.9
#: Numbers of a list are no versions.
_LIST = re.compile(r"(?m)(^[ \t*#/;-]*|[.;:][ \t]+)\(?[0-9]{1,2}[.)](?=[ \t])")
_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
_FILE = r"(?i)^(licen[cs]e|copying|notice)([._-].*)?$"


def _variant(word: str) -> str:
    return word[:-2] if word.endswith(".0") else word


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _vocabulary() -> dict[str, int]:
    found = sorted({w for forms in TEMPLATES.values() for t in forms for w in _words(t)})
    return {w: i for i, w in enumerate(found)}


def line_counts(files: DataFrame) -> tuple[int, np.ndarray]:
    """(lines of all files, lines that hold each word of the templates): one row a word reaches the driver."""
    place = _vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, lines = np.zeros(len(place), np.int64), 0
        for batch in batches:
            for text in strings(batch.column(0)).to_pylist():
                for line in _LIST.sub(r"\1", text.lower()).split("\n"):
                    if line and not line.isspace():
                        lines += 1
                        for w in place.keys() & set(_WORD.findall(line)):
                            df[place[w]] += 1
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(df)), -1], pa.int32()), pa.array([*df, lines], pa.int64())], names=["word", "n"])

    got = {r["word"]: r["n"] for r in map_arrow(files.select("text"), run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return got.get(-1, 0), np.array([got.get(i, 0) for i in range(len(place))])


class Matcher:
    def __init__(self, lines: int, df: np.ndarray):
        self.place = _vocabulary()
        self.idf = np.log((lines + 1) / (df + 1)) + 1
        self.unknown = float(np.log(lines + 1) + 1)
        named = [(name, _words(t)) for name, forms in sorted(TEMPLATES.items()) for t in forms]
        self.names = [name for name, _ in named]
        self.variants = [frozenset(map(_variant, w)) & VARIANTS for _, w in named]
        self.lengths = [len(w) for _, w in named]
        self.longest = max(self.lengths)
        self.matrix = np.zeros((len(self.place), len(named)))  # weight of each word in each template, of length 1
        for k, (_, w) in enumerate(named):
            for x in set(w):
                self.matrix[self.place[x], k] = (1 + log(w.count(x))) * self.idf[self.place[x]]
        self.matrix /= np.sqrt((self.matrix**2).sum(0))

    @cached_property
    def needed(self) -> frozenset[str]:
        """Words of which every matching window has one: without a template's heaviest words, whose squares are more than
        1 - THRESHOLD ** 2 together, no cosine with it reaches the threshold."""
        by_place = {i: w for w, i in self.place.items()}
        out = set()
        for column in self.matrix.T:
            order = np.argsort(-column, kind="stable")
            enough = int(np.searchsorted(np.cumsum(column[order] ** 2), 1 - THRESHOLD**2 + 1e-9)) + 1
            out |= {by_place[int(i)] for i in order[:enough]}
        return frozenset(out)

    def best(self, text: str, whole: bool = False) -> tuple[str | None, float]:
        """(license, cosine) of the best window of lines of up to twice the longest template's words, and (whole) of those from the first
        line on; (None, 0) if none matches. Of templates with FULL or more the longest wins, else the greatest cosine; ties by name. The
        cosine is the greatest one with any template of that license."""
        lines = [x for x in map(_WORD.findall, _LIST.sub(r"\1", text.lower()).split("\n")) if x]
        marked = [k for k, x in enumerate(lines) if not self.needed.isdisjoint(x)]
        if not marked:
            return None, 0.0
        known = [any(w in self.place for w in x) for x in lines]
        upto = np.concatenate([[0], np.cumsum([len(x) for x in lines])])
        top: dict[int, float] = {}
        for i in range(len(lines)):
            if not known[i]:  # a window is better without a line of unknown words at its ends
                continue
            unbounded = whole and i == 0
            next_ = bisect_left(marked, i)
            if next_ == len(marked):
                break
            first = marked[next_]
            if first > i and not unbounded and upto[first] - upto[i] > 2 * self.longest:
                continue
            counts: dict[str, int] = {}
            dots = np.zeros(len(self.names))
            own, others, variants = 0.0, 0.0, set()
            for j in range(i, len(lines)):
                if j > i and not unbounded and upto[j + 1] - upto[i] > 2 * self.longest:
                    break
                for w in lines[j]:
                    c = counts[w] = counts.get(w, 0) + 1
                    before, now = (1 + log(c - 1)) if c > 1 else 0.0, 1 + log(c)
                    at = self.place.get(w)
                    if at is None:
                        others += (now * now - before * before) * self.unknown**2
                    else:
                        # only known words add to a cosine, so their share of the squared length bounds its square
                        own += (now * now - before * before) * self.idf[at] ** 2
                        dots += (now - before) * self.idf[at] * self.matrix[at]
                    if _variant(w) in VARIANTS:
                        variants.add(_variant(w))
                if j >= first and known[j] and own >= (THRESHOLD**2 - 1e-9) * (own + others):
                    cosine = dots / sqrt(own + others)
                    for k in np.flatnonzero(cosine >= THRESHOLD).tolist():
                        if self.variants[k] == variants:
                            top[k] = max(top.get(k, 0.0), min(1.0, round(float(cosine[k]), 12)))
        if not top:
            return None, 0.0
        k = min(top, key=lambda k: (-self.lengths[k] if top[k] >= FULL else 0, -top[k], -self.lengths[k], self.names[k]))
        return self.names[k], max(c for j, c in top.items() if self.names[j] == self.names[k])


def scan(files: DataFrame) -> DataFrame:
    """files (doc_id, path, text) -> doc_id, path, own_license, cosine, license, inherited_from (a directory or null)."""
    matcher = Matcher(*line_counts(files))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(1).to_pylist()
            found = [matcher.best(t, bool(re.match(_FILE, p.rsplit("/", 1)[-1]))) for p, t in zip(paths, strings(batch.column(2)).to_pylist(), strict=True)]
            own = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *own], names=["doc_id", "path", "own_license", "cosine"])

    rows = files.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("path", F.lit("")).alias("path"), "text")
    rows = map_arrow(rows, run, "doc_id long, path string, own_license string, cosine double")
    rows = save(rows.withColumn("dir", F.regexp_replace("path", r"/?[^/]*$", "")), "licenses")
    name = F.regexp_extract("path", r"[^/]*$", 0)
    stated = rows.where(F.col("own_license").isNotNull() & name.rlike(_FILE)).groupBy("dir").agg(F.max_by("own_license", F.struct("cosine", "own_license", "path")).alias("stated"))
    # ancestors of each distinct directory, nearest first: '' is the root
    steps = F.split("dir", "/")
    depth = F.sequence(F.size(steps), F.lit(0))
    up = F.posexplode(F.transform(depth, lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))).alias("up", "ancestor")
    dirs = rows.select("dir").distinct().select("dir", up)
    near = dirs.join(stated.withColumnRenamed("dir", "ancestor"), "ancestor").groupBy("dir").agg(F.min_by(F.struct("ancestor", "stated"), "up").alias("from"))
    near = save(near, "license-dirs")
    few = near.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    out = rows.join(F.broadcast(near) if few else near, "dir", "left")
    given = F.coalesce("own_license", F.col("from.stated")).alias("license")
    inherited = F.when(F.col("own_license").isNull(), F.col("from.ancestor")).alias("inherited_from")
    return out.select("doc_id", "path", "own_license", F.round("cosine", 9).alias("cosine"), given, inherited)


def document_paths(docs: DataFrame, size: int = 100) -> DataFrame:
    """A file tree out of documents, which have no paths: source / language / a folder for each `size` ids; documents that
    end in a license line and are short play the license file of their folder."""
    text = F.coalesce("text", F.lit(""))
    states = (F.length(text) < 600) & text.rlike(r"(?i)\blicensed?\b")
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    kind = F.when(states, F.concat(F.lit("LICENSE."), ids)).otherwise(F.concat(F.lit("doc"), ids, F.lit(".txt")))
    number = F.coalesce(F.floor(F.col("doc_id") / size).cast("string"), F.lit("none"))
    folder = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), number)
    return docs.select("doc_id", F.concat_ws("/", folder, kind).alias("path"), "text")
