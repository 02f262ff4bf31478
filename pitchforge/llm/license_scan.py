"""Licence notices by a trained paragraph classifier (operator 3).

1. Candidates: neighbouring lines with pairs of words from a licence template form
   a block, and stretches of a block around such pairs are its candidate paragraphs.
   Text without such a pair is ``unknown`` without further work, as it has less than
   two words that tell it apart.
2. Classifier: a multinomial logistic regression on sparse word n-grams (1 to 3
   words that occur in a template) proposes the families of each candidate.  It is
   trained in numpy on altered pieces of the templates against a bounded sample of
   the corpus' lines and scrambled licence words, the class ``unknown``.
   Temperature and the bias of ``unknown`` are calibrated on held-out pieces.
3. Comparison confirms a proposed family: a stretch of which at least 0.8 of the five-word
   shingles are in the family's notices, that covers most of one of its
   paragraphs, and that tells the family from every other one (``tells``).

Families share paragraphs (a BSD-2-Clause notice is part of a BSD-3-Clause one) or differ in a
word (versions, "Affero", "NoDerivatives").  Where a paragraph of the notice that the block has holds shingles
that another family lacks, half of these must be there, in each such paragraph.  Where none does,
the notice may be part of the other family's; then it must be complete while the rest of
that one is missing.  Otherwise the family stays unconfirmed.

Null and empty texts have no licence; repeated rows get equal results; a null
id stays null; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow

SHINGLE, SIMILARITY = 5, 0.8
#: Share of a paragraph's shingles that a stretch of a line must have to stand for it.
COVERED = 0.6
#: Share of the shingles that tell two families apart which must be there.
TELLING = 0.5
#: Chance from which the classifier proposes a family.
PROPOSED = 0.02
#: Bound on the lines of the corpus that train the class ``unknown``.
SAMPLE_LINES = 20_000
UNKNOWN = "unknown"

# Notices of public licences, by family; each notice is whole, as its consecutive paragraphs.
_CC = "To view a copy of this license, visit http://creativecommons.org/licenses/{}/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."
_CC_NAMES = {"by": "Attribution", "by-nc": "Attribution-NonCommercial", "by-sa": "Attribution-ShareAlike", "by-nd": "Attribution-NoDerivatives",
             "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
_FREE = ("This program is free software: you can redistribute it and/or modify it under the terms of the {} as published by "
         "the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
_HOPE = ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
         "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {} for more details.")
_COPY = "You should have received a copy of the {} along with this program. If not, see https://www.gnu.org/licenses/."
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
NOTICES: dict[str, tuple[tuple[str, ...], ...]] = {
    "Apache-2.0": (
        ("Licensed under the Apache License, Version 2.0",),
        ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
         "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
         "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
         "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
         "See the License for the specific language governing permissions and limitations under the License."),
    ),
    "MIT": (
        ("Released under the MIT License.",),
        ("This project is licensed under the MIT License.",),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
         "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
         "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
         "and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
         "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
         "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
         "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
         "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
         "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ),
    "BSD-2-Clause": ((*_BSD, _BSD_DISCLAIMER),),
    "BSD-3-Clause": ((*_BSD, "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                      "products derived from this software without specific prior written permission.", _BSD_DISCLAIMER),),
    "GPL-3.0": (
        ("This work is licensed under the GNU General Public License, version 3.",),
        (_FREE.format("GNU General Public License", "3"), _HOPE.format("GNU General Public License"), _COPY.format("GNU General Public License")),
    ),
    "GPL-2.0": (
        ("This work is licensed under the GNU General Public License, version 2.",),
        (_FREE.format("GNU General Public License", "2"), _HOPE.format("GNU General Public License"),
         "You should have received a copy of the GNU General Public License along with this program; if not, write to the Free "
         "Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."),
    ),
    "LGPL-3.0": (
        ("This work is licensed under the GNU Lesser General Public License, version 3.",),
        (_FREE.format("GNU Lesser General Public License", "3"), _HOPE.format("GNU Lesser General Public License"),
         _COPY.format("GNU Lesser General Public License")),
    ),
    "LGPL-2.1": (
        ("This work is licensed under the GNU Lesser General Public License, version 2.1.",),
        ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
         "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
         "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
         "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
         "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free "
         "Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."),
    ),
    "AGPL-3.0": (
        ("This work is licensed under the GNU Affero General Public License, version 3.",),
        (_FREE.format("GNU Affero General Public License", "3"), _HOPE.format("GNU Affero General Public License"),
         _COPY.format("GNU Affero General Public License")),
    ),
    "ISC": (
        ("Released under the ISC License.",),
        ("This project is licensed under the ISC License.",),
        ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
         "provided that the above copyright notice and this permission notice appear in all copies.",
         "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
         "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
         "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
         "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ),
    "EPL-2.0": (
        ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
         "available at https://www.eclipse.org/legal/epl-2.0/",),
    ),
    "Unlicense": (
        ("This is free and unencumbered software released into the public domain.",
         "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
         "compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ),
    "CC0-1.0": (
        ("Licensed under CC0 1.0.",),
        ("This work is licensed under a Creative Commons CC0 1.0 Universal License.",),
        ("To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this "
         "software to the public domain worldwide. This software is distributed without any warranty.",
         "You should have received a copy of the CC0 Public Domain Dedication along with this software. If not, see "
         "http://creativecommons.org/publicdomain/zero/1.0/."),
    ),
    "MPL-2.0": (
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
         "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",),
    ),
    **{f"CC-{short.upper()}-4.0": (
        (f"Licensed under CC {short.upper()} 4.0.",),
        (f"This work is licensed under a Creative Commons {name} 4.0 International License.",),
        (f"This work is licensed under the Creative Commons {name} 4.0 International License. " + _CC.format(short),),
    ) for short, name in _CC_NAMES.items()},
}
#: The paragraphs of each family's notices.
TEMPLATES: dict[str, tuple[str, ...]] = {f: tuple(p for n in ns for p in n) for f, ns in NOTICES.items()}

_WORD = re.compile(r"[a-z0-9]+")


def words_of(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def grams(words: list[str]) -> list[str]:
    """The 1- to 3-grams of a paragraph."""
    return [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def shingles(words: list[str], width: int = SHINGLE) -> set[tuple[str, ...]]:
    """Runs of ``width`` words; the whole of a shorter paragraph."""
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def vocabulary() -> dict[str, int]:
    """Numbers of the n-grams of all templates."""
    return {g: i for i, g in enumerate(dict.fromkeys(g for ts in TEMPLATES.values() for t in ts for g in grams(words_of(t))))}


def active(words: list[str], known: dict[str, int]) -> list[int]:
    """The known n-grams of a paragraph, each once."""
    return [known[g] for g in dict.fromkeys(grams(words)) if g in known]


class LicenceModel:
    """``background``: lines of the corpus, as texts or as indices of their n-grams, for ``unknown``."""

    def __init__(self, background: list, seed: int = 3):
        self.families = [UNKNOWN, *TEMPLATES]
        self.vocabulary = vocabulary()
        self.pairs = {g for g in self.vocabulary if g.count(" ") == 1}
        self.words = {g for g in self.vocabulary if " " not in g}
        self.index = {f: i for i, f in enumerate(self.families)}
        self.shingles = {f: set().union(*(shingles(words_of(" ".join(n))) for n in ns)) for f, ns in NOTICES.items()}
        self.notices = {f: [[shingles(words_of(t)) for t in n] for n in ns] for f, ns in NOTICES.items()}
        rng = np.random.default_rng(seed)
        self.weights = np.zeros((len(self.vocabulary), len(self.families)))
        self.bias, self.temperature, self.unknown_bias = np.zeros(len(self.families)), 1.0, 0.0
        x, y = self.examples(background, rng)
        held = rng.random(len(y)) < 0.25
        self.fit([f for f, h in zip(x, held, strict=True) if not h], y[~held], rng)
        self.calibrate([f for f, h in zip(x, held, strict=True) if h], y[held])

    def examples(self, background, rng, variants: int = 60):
        """Altered pieces of the templates; for ``unknown`` corpus paragraphs and scrambled words."""
        x, y, pool = [], [], sorted(self.words)
        for label, texts in enumerate(TEMPLATES.values(), 1):
            for text in texts:
                whole = words_of(text)
                for v in range(variants):
                    w = whole
                    if v % 3 == 1 and len(whole) > 10:  # a piece
                        size = int(rng.integers(8, len(whole) + 1))
                        at = int(rng.integers(0, len(whole) - size + 1))
                        w = whole[at:at + size]
                    elif v % 3 == 2:  # a word is lost or strange
                        w = list(whole)
                        at = int(rng.integers(0, len(w)))
                        w[at:at + 1] = [] if rng.random() < 0.5 else ["x" + str(v)]
                    x.append(self.active(w))
                    y.append(label)
        n = len(y)
        scrambled = [[pool[i] for i in rng.integers(0, len(pool), int(rng.integers(3, 30)))] for _ in range(n // 2)]
        lines = [self.active(words_of(p)) if isinstance(p, str) else p for p in background[:2 * n]]
        for f in [self.active(w) for w in scrambled] + lines:
            x.append(f)
            y.append(0)
        return x, np.array(y)

    def active(self, words: list[str]) -> list[int]:
        return active(words, self.vocabulary)

    def logits(self, features: list[list[int]]) -> np.ndarray:
        out = np.tile(self.bias, (len(features), 1))
        for i, f in enumerate(features):
            if f:
                out[i] += self.weights[f].sum(axis=0) / len(f) ** 0.5
        return out

    def fit(self, x, y, rng, epochs: int = 12, rate: float = 0.5, decay: float = 1e-4) -> None:
        """Stochastic gradient steps on batches of sparse examples."""
        size, squares = 64, np.full(self.weights.shape, 1e-2)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for lo in range(0, len(order), size):
                pick = order[lo:lo + size]
                d = probabilities(self.logits([x[i] for i in pick]))
                d[np.arange(len(pick)), y[pick]] -= 1
                self.bias -= 0.1 * d.mean(axis=0)
                g = np.zeros_like(self.weights)
                for row, i in zip(d, pick, strict=True):
                    if x[i]:
                        g[x[i]] += row / len(x[i]) ** 0.5
                g += decay * self.weights
                squares += g * g
                self.weights -= rate * g / np.sqrt(squares)

    def calibrate(self, x, y) -> None:
        """Temperature and bias of ``unknown`` with the least log loss on held-out examples."""
        z = self.logits(x)
        best = np.inf
        for t in (0.5, 0.7, 1.0, 1.4, 2.0, 3.0):
            for b in np.linspace(-2, 2, 9):
                shifted = z / t
                shifted[:, 0] += b
                loss = -np.log(probabilities(shifted)[np.arange(len(y)), y] + 1e-12).mean()
                if loss < best:
                    best, self.temperature, self.unknown_bias = loss, t, float(b)

    def chances(self, words: list[str]) -> np.ndarray:
        """Probability of each family."""
        z = self.logits([self.active(words)]) / self.temperature
        z[:, 0] += self.unknown_bias
        return probabilities(z)[0]

    def scan(self, text: str | None) -> list[dict]:
        """Licence paragraphs of a text: line (from 0), family, score, similarity, confirmed."""
        lines = []
        for n, line in enumerate((text or "").split("\n")):
            words = words_of(line)
            if len(self.words.intersection(words)) >= 2 and any(f"{a} {b}" in self.pairs for a, b in zip(words, words[1:], strict=False)):
                lines.append((n, words))
        out, at = [], 0
        while at < len(lines):
            end = at + 1
            # a line without licence words may lie between two of a notice
            while end < len(lines) and lines[end][0] - lines[end - 1][0] <= 2:
                end += 1
            out += self.scan_block(lines[at:end])
            at = end
        return out

    def scan_block(self, lines: list[tuple[int, list[str]]]) -> list[dict]:
        """Candidates of neighbouring lines: what the classifier proposes, confirmed by comparison if possible."""
        words = [w for _, ws in lines for w in ws]
        line_of = [n for n, ws in lines for _ in ws]
        pieces, proposals = self.pieces(words), {}
        chances = [self.chances(words[lo:hi]) for lo, hi in pieces]
        for (lo, hi), p in zip(pieces, chances, strict=True):
            for i in np.flatnonzero(p >= PROPOSED):
                if i:
                    proposals.setdefault(self.families[i], []).append((lo, hi, float(p[i])))
        block = [tuple(words[i:i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]
        have, near = set(block), []
        for family, places in proposals.items():
            ends = [hi for _, hi, _ in places]
            marks = [s in self.shingles[family] for s in block]
            for lo, hi in stretches(marks) if any(marks) else ():
                score, k, n = 0.0, bisect_right(ends, lo), sum(marks[lo:hi])
                while k < len(places) and places[k][0] < hi + SHINGLE - 1:  # the candidates it overlaps
                    score, k = max(score, places[k][2]), k + 1
                if score and self.tells(family, set(block[lo:hi]), have):
                    near.append((n - SIMILARITY * (hi - lo), score, lo, hi + SHINGLE - 1, family, n / (hi - lo)))
        sure: list[tuple[int, int, str, float, float, bool]] = []
        for _, score, lo, hi, family, share in sorted(near, key=lambda x: (-x[0], -x[1], x[2], x[4])):
            at = bisect_left(sure, (lo,))
            if (at == 0 or sure[at - 1][1] <= lo) and (at == len(sure) or sure[at][0] >= hi):
                sure.insert(at, (lo, hi, family, score, share, True))
        found = [*sure]
        for (lo, hi), p in zip(pieces, chances, strict=True):
            before = bisect_left(sure, (hi,))
            if p.argmax() and not (before and sure[before - 1][1] > lo):
                family = self.families[int(p.argmax())]
                found.append((lo, hi, family, float(p.max()), self.similarity(family, words[lo:hi]), False))
        return [{"line": line_of[lo], "family": f, "score": p, "similarity": share, "confirmed": ok}
                for lo, _, f, p, share, ok in sorted(found)]

    def similarity(self, family: str, words: list[str]) -> float:
        """Share of a paragraph's shingles that the family's notices have."""
        s = shingles(words)
        return len(s & self.shingles[family]) / len(s) if s else 0.0

    def tells(self, family: str, stretch: set, have: set) -> bool:
        """Whether a stretch that covers a paragraph of ``family`` is no other family's, in a block with shingles ``have``."""
        for notice in self.notices[family]:
            if any(len(stretch & p) >= COVERED * len(p) for p in notice):
                seen = [p for p in notice if len(have & p) >= COVERED * len(p)]
                if all(self.differs(seen, notice, other, have) for other in self.notices if other != family):
                    return True
        return False

    def differs(self, seen: list[set], notice: list[set], other: str, have: set) -> bool:
        """Whether the paragraphs of a notice that a block has are not the other family's; none may contradict."""
        telling = [t for p in seen if (t := p - self.shingles[other])]
        if telling:
            return all(len(t & have) >= TELLING * len(t) for t in telling)
        own = set().union(*notice)
        if own - self.shingles[other]:
            return False  # what would tell is missing
        # the notice is part of the other family's: it has to be whole, and the rest of that one missing
        rest = [set().union(*n) - own for n in self.notices[other] if set().union(*n) & own]
        return len(own & have) >= SIMILARITY * len(own) and all(len(r & have) < TELLING * len(r) for r in rest if r)

    def pieces(self, words: list[str]) -> list[tuple[int, int]]:
        """Stretches (first word, end) around pairs of template words that lie close together."""
        hit = [i for i, (a, b) in enumerate(zip(words, words[1:], strict=False)) if f"{a} {b}" in self.pairs]
        out, at = [], 0
        while at < len(hit):
            end = at
            while end + 1 < len(hit) and hit[end + 1] - hit[end] <= 3:
                end += 1
            out.append((hit[at], hit[end] + 2))
            at = end + 1
        return out


def stretches(marks: list[bool]) -> list[tuple[int, int]]:
    """All maximal stretches [start, end) in which the share of marks is over SIMILARITY.

    Ruzzo and Tompa's scan: each stretch knows the last one before it whose sum ahead is smaller, so that the
    search for a stretch to join takes linear time in all.
    """
    out: list[tuple[int, int, float, float, int]] = []  # start, end, sum before it, sum at its end, last with a smaller one before
    total = 0.0
    for i, m in enumerate(marks):
        before, total = total, total + (1 - SIMILARITY if m else -SIMILARITY)
        if not m:
            continue
        start, end = i, total
        j = len(out) - 1
        while True:
            while j >= 0 and out[j][2] >= before:
                j = out[j][4]
            if j < 0 or out[j][3] >= end:
                out.append((start, i + 1, before, end, j))
                break
            start, before, k = out[j][0], out[j][2], out[j][4]
            del out[j:]
            j = k
    return [(lo, hi) for lo, hi, *_ in out]


def probabilities(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(docs: DataFrame, sample_lines: int = SAMPLE_LINES, text_col: str = "text") -> LicenceModel:
    """Fit the model; at most twice ``sample_lines`` lines, chosen by a hash, stand for ``unknown``.

    Whole lines become numbers of n-grams on the executors, so a long one sends no
    more than the vocabulary.  Lines with two words in a row of a template are left
    out, as they may be notices.
    """
    known = vocabulary()
    lines = F.split("text", "\n")
    src = narrow(docs, text=text_col).where("text is not null")
    total = src.agg(F.sum(F.size(lines))).first()[0] or 1
    share = int(min(1.0, sample_lines / total) * (1 << 30))
    picked = src.select(F.posexplode(lines).alias("n", "line")).withColumn("pick", F.pmod(F.xxhash64("line", "n"), F.lit(1 << 30)))

    @F.pandas_udf("array<int>")
    def numbers(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            words = words_of(t)
            bare = not any(f"{a} {b}" in known for a, b in zip(words, words[1:], strict=False))
            out.append(active(words, known) if words and bare else None)
        return pd.Series(out, dtype=object)

    rows = picked.where(F.col("pick") < share).select("pick", numbers("line").alias("x")).where("x is not null")
    rows = rows.limit(2 * sample_lines).toPandas()
    order = sorted(zip(rows["pick"], map(tuple, rows["x"]), strict=True))
    return LicenceModel([list(x) for _, x in order])


def find_licences(docs: DataFrame, model: LicenceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, found array<struct<line, family, score, similarity, confirmed>>) of all documents."""

    @F.pandas_udf("array<struct<line: int, family: string, score: double, similarity: double, confirmed: boolean>>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.scan(t) for t in texts], dtype=object)

    return narrow(docs, doc_id=id_col, text=text_col).select("doc_id", scan("text").alias("found"))


def summary(found: DataFrame) -> DataFrame:
    """Rows (doc_id, licences, n_confirmed, n_unconfirmed, score): confirmed families joined by name."""
    sure = F.filter("found", lambda x: x["confirmed"])
    return found.select(
        "doc_id", F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("licences"),
        F.size(sure).cast("long").alias("n_confirmed"), (F.size("found") - F.size(sure)).cast("long").alias("n_unconfirmed"),
        F.coalesce(F.array_max(F.transform(sure, lambda x: x["score"])), F.lit(0.0)).alias("score"))
