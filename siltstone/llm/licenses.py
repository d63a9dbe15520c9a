"""Licence scans: paragraphs classified into licence families, confirmed by comparison with templates.

Lower-cased word 1- to 3-grams are hashed to sparse features of a multinomial logistic regression whose
classes are the families and "unknown". It is trained on variations of the templates against a bounded
sample of the scanned corpus; probabilities are calibrated by a temperature on held-out rows. A paragraph is a run
of lines that hold words, so that notices are found across line breaks. Of the overlapping windows of about a template's
length that start anywhere in it, those that hold enough of the template are classified by themselves, and a window
stands if its family is predicted. Titles on a line of their own and SPDX identifiers name their family.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.kernels import Rolling, lower_ascii, mix, ragged, slices, text_bytes, word_spans

# Usual notices of each family.
TEMPLATES = {
    "AGPL": (
        "This program is free software under the GNU Affero General Public License, version 3.",
        "Licensed under the GNU Affero General Public License v3.0 or later.",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Released under the Apache 2.0 license.",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "CC-BY-NC": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "CC-BY-SA": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
        "Released under the GPL v2 license.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "Released under the ISC License.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the LGPL v3 license.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "Licensed under the MIT license.",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ),
}
# The paragraphs of whole licences that are short, and the notices and main clauses of long ones.
GNU = (
    "This {work} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version.",
    "This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.",
    "You should have received a copy of the GNU {name} along with this {work}; if not, see https://www.gnu.org/licenses/.",
)
PARAGRAPHS = {
    "AGPL": tuple(x.format(work="program", name="Affero General Public License", version="3") for x in GNU),
    "Apache": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
        "Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    ),
    "BSD": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    ),
    "GPL": tuple(x.format(work="program", name="General Public License", version="2") for x in GNU),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ),
    "LGPL": tuple(x.format(work="library", name="Lesser General Public License", version="2.1") for x in GNU),
    "MIT": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
}
# Lines that are the title of a licence and hold nothing else.
TITLES = {
    "AGPL": ("GNU Affero General Public License", "GNU Affero General Public License v3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    "Apache": ("Apache License", "Apache License 2.0", "Apache License, Version 2.0", "Apache License Version 2.0, January 2004"),
    "BSD": ("BSD License", "The BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "The 2-Clause BSD License", "The 3-Clause BSD License", 'BSD 2-Clause "Simplified" License', 'BSD 3-Clause "New" or "Revised" License'),
    "CC-BY": ("Attribution 4.0 International", "Creative Commons Attribution 4.0 International", "Creative Commons Attribution 4.0 International Public License"),
    "CC-BY-NC": ("Attribution-NonCommercial 4.0 International", "Creative Commons Attribution-NonCommercial 4.0 International", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    "CC-BY-SA": ("Attribution-ShareAlike 4.0 International", "Creative Commons Attribution-ShareAlike 4.0 International", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    "CC0": ("CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"),
    "GPL": ("GNU General Public License", "GNU General Public License v2.0", "GNU General Public License v3.0", "GNU General Public License Version 2, June 1991", "GNU General Public License Version 3, 29 June 2007"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "LGPL": ("GNU Lesser General Public License", "GNU Library General Public License", "GNU Lesser General Public License v2.1", "GNU Lesser General Public License v3.0", "GNU Lesser General Public License Version 2.1, February 1999", "GNU Lesser General Public License Version 3, 29 June 2007"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "MPL": ("Mozilla Public License", "Mozilla Public License 2.0", "Mozilla Public License Version 2.0"),
}
SPDX_TAG = "SPDX-License-Identifier"
GNU_FORMS = ("", "-only", "-or-later")
SPDX = {
    "AGPL": tuple(f"AGPL-{v}{end}" for v in ("1.0", "3.0") for end in GNU_FORMS),
    "Apache": ("Apache-1.0", "Apache-1.1", "Apache-2.0"),
    "BSD": ("0BSD", "BSD-1-Clause", "BSD-2-Clause", "BSD-2-Clause-Patent", "BSD-3-Clause", "BSD-3-Clause-Clear", "BSD-4-Clause"),
    "CC-BY": tuple(f"CC-BY-{v}" for v in ("1.0", "2.0", "2.5", "3.0", "4.0")),
    "CC-BY-NC": tuple(f"CC-BY-NC-{v}" for v in ("1.0", "2.0", "2.5", "3.0", "4.0")),
    "CC-BY-SA": tuple(f"CC-BY-SA-{v}" for v in ("1.0", "2.0", "2.5", "3.0", "4.0")),
    "CC0": ("CC0-1.0",),
    "GPL": tuple(f"GPL-{v}{end}" for v in ("1.0", "2.0", "3.0") for end in GNU_FORMS),
    "ISC": ("ISC",),
    "LGPL": tuple(f"LGPL-{v}{end}" for v in ("2.0", "2.1", "3.0") for end in GNU_FORMS),
    "MIT": ("MIT", "MIT-0"),
    "MPL": ("MPL-1.0", "MPL-1.1", "MPL-2.0", "MPL-2.0-no-copyleft-exception"),
}
TEMPLATES = {family: own + PARAGRAPHS.get(family, ()) for family, own in TEMPLATES.items()}
FAMILIES = tuple(TEMPLATES)


@dataclass(frozen=True)
class Licences:
    """``sample``: corpus paragraphs, of at most ``sample_bytes`` each, that the classifier is fitted on."""

    buckets: int = 1 << 16
    order: int = 3
    variations: int = 40
    sample: int = 2_000
    sample_bytes: int = 1_000
    rounds: int = 60
    decay: float = 1e-5
    least_probability: float = 0.5
    least_overlap: float = 0.6
    seed: int = 5


@dataclass
class Model:
    """``weights``: buckets by classes, the last class is unknown; ``grams``: template bigrams by template."""

    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    held_out_accuracy: float
    grams: list[tuple[int, np.ndarray]]


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words without ASCII punctuation at their ends, and each paragraph's first.

    Marks of comments and lists, which are nothing but punctuation, are no words.
    """
    data = lower_ascii(data)
    starts, ends, first = word_spans(data, bounds)
    letter = (data >= 128) | ((data - np.uint8(97)) < 26) | ((data - np.uint8(48)) < 10)
    at = np.arange(len(data))
    nxt = np.minimum.accumulate(np.where(letter, at, len(data))[::-1])[::-1]
    last = np.maximum.accumulate(np.where(letter, at, -1))
    if len(starts):
        a, b = np.minimum(nxt[starts], ends), last[ends - 1] + 1
        held = b > a
        starts, ends, first = a[held], b[held], np.concatenate([[0], np.cumsum(held)])[first]
    return Rolling(data).spans(starts, ends), first


def grams_of(words: np.ndarray, first: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 1- to ``order``-grams, and the paragraph of each."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out, owners, run = [words], [owner], words
    for k in range(1, order):
        run = mix(run[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[k:]) if len(words) > k else run[:0]
        inside = owner[k:] == owner[: max(0, len(owner) - k)]
        out.append(run[inside])
        owners.append(owner[k:][inside])
    return np.concatenate(out), np.concatenate(owners)


def _lines(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(pa.array(texts, pa.large_string()))


def _features(texts: list[str], c: Licences) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, paragraph and weight of each gram; the weights of a paragraph have unit length."""
    grams, owner = grams_of(*words_of(*_lines(texts)), c.order)
    weight = 1 / np.sqrt(np.maximum(1, np.bincount(owner, minlength=len(texts))))
    return (grams % np.uint64(c.buckets)).astype(np.int64), owner, weight[owner]


def variations(c: Licences, filler: list[str]) -> tuple[list[str], list[int]]:
    """Templates with words dropped, replaced, put in other cases and set among other words."""
    draw, texts, labels = np.random.default_rng(c.seed), [], []
    filler = filler or ["the", "of", "and"]
    some = lambda n: [filler[i] for i in draw.integers(0, len(filler), n)]
    for k, family in enumerate(FAMILIES):
        for template in TEMPLATES[family]:
            texts.append(template)
            labels.append(k)
            for _ in range(c.variations):
                words = template.split()
                drop = draw.random(len(words)) < 0.05
                words = [w for w, d in zip(words, drop, strict=True) if not d] or words
                words = some(int(draw.integers(0, 6))) + words + some(int(draw.integers(0, 6)))
                text = " ".join(words)
                texts.append(text.upper() if draw.random() < 0.1 else text)
                labels.append(k)
    return texts, labels


def overlap(words: np.ndarray, template: np.ndarray) -> float:
    """Share of the template's word pairs that the paragraph has."""
    return float(np.isin(template, _pairs(words)).mean())


def _pairs(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * np.uint64(3) + words[1:])


def _template_grams() -> list[tuple[int, np.ndarray]]:
    out = []
    for k, family in enumerate(FAMILIES):
        for template in TEMPLATES[family]:
            out.append((k, np.unique(_pairs(words_of(*_lines([template]))[0]))))
    return out


def fit(sample: list[str], c: Licences) -> Model:
    """Softmax regression by gradient steps with momentum on three quarters of the rows, calibrated on the rest."""
    grams = _template_grams()
    words, first = words_of(*_lines(sample))
    parts = [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
    every = np.unique(np.concatenate([g for _, g in grams]))
    # Neither much of a template, nor a line of a wrapped one.
    clean = [
        s for s, w in zip(sample, parts, strict=True)
        if not any(overlap(w, g) >= 0.3 for _, g in grams) and not (len(w) > 1 and np.isin(_pairs(w), every).mean() >= 0.3)
    ]
    filler = [w for s in clean[:500] for w in s.split()][:20_000]
    texts, labels = variations(c, filler)
    texts, labels = texts + clean, np.array(labels + [len(FAMILIES)] * len(clean))
    bucket, owner, weight = _features(texts, c)
    held = np.random.default_rng(c.seed + 1).random(len(texts)) < 0.25
    classes = len(FAMILIES) + 1
    target = np.eye(classes)[labels]
    share = np.bincount(labels[~held], minlength=classes)
    balance = np.where(held, 0.0, 1 / np.maximum(1, share[labels]) / classes)
    balance[(labels == classes - 1) & ~held] *= 4
    used, place = np.unique(bucket, return_inverse=True)
    w, v, bias = np.zeros((classes, len(used))), np.zeros((classes, len(used))), np.zeros(classes)

    def scores(w: np.ndarray, bias: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(owner, w[k][place] * weight, len(texts)) for k in range(classes)], 1) + bias

    def soft(s: np.ndarray) -> np.ndarray:
        e = np.exp(s - s.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    for _ in range(c.rounds):
        error = (soft(scores(w, bias)) - target) * balance[:, None]
        by_class = np.ascontiguousarray(error.T)
        slope = np.stack([np.bincount(place, e[owner] * weight, len(used)) for e in by_class])
        v = 0.9 * v - 20.0 * (slope + c.decay * w)
        w, bias = w + v, bias - 2.0 * error.sum(0)
    s = scores(w, bias)[held]
    answers = labels[held]
    loss = lambda t: -np.log(np.maximum(1e-12, soft(s / t)[np.arange(len(s)), answers])).mean()
    temperature = min((t for t in np.geomspace(0.1, 10, 41)), key=loss) if len(s) else 1.0
    full = np.zeros((c.buckets, classes), np.float32)
    full[used] = w.T
    return Model(full, bias, float(temperature), float((s.argmax(1) == answers).mean()) if len(s) else 1.0, grams)


def corpus_sample(docs: DataFrame, c: Licences) -> list[str]:
    """A bounded sample of paragraphs, the smallest by hash, in the order of the hash.

    The paragraphs are counted first, so that about half as many again as are wanted pass the hash filter
    and reach the driver, however many tasks there are.
    """
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("x")).where(
        (F.length("x") > 0) & (F.octet_length("x") <= c.sample_bytes)
    )
    share = min(1.0, (1.5 * c.sample + 50) / max(1, lines.count()))
    rank = F.pmod(F.xxhash64("doc_id", "x"), F.lit(1 << 31))
    top = lines.where(rank <= int(share * (1 << 31))).orderBy(rank, "x").limit(c.sample)
    return [row["x"] for row in top.select("x").collect()]


def _chances(m: Model, words: np.ndarray, first: np.ndarray, c: Licences) -> np.ndarray:
    """Calibrated probabilities, pieces by classes."""
    grams, owner = grams_of(words, first, c.order)
    bucket, count = (grams % np.uint64(c.buckets)).astype(np.int64), len(first) - 1
    size = np.sqrt(np.maximum(1, np.bincount(owner, minlength=count)))
    score = np.stack([np.bincount(owner, m.weights[bucket, k], count) for k in range(m.weights.shape[1])], 1)
    score = (score / size[:, None] + m.bias) / m.temperature
    score = np.exp(score - score.max(1, keepdims=True))
    return score / score.sum(1, keepdims=True)


def _members(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Where ``values`` has values of the sorted ``known``."""
    rough = np.zeros(1 << 16, bool)
    rough[known & np.uint64(0xFFFF)] = True
    at = np.flatnonzero(rough[values & np.uint64(0xFFFF)])
    found = np.minimum(np.searchsorted(known, values[at]), len(known) - 1)
    return at[known[found] == values[at]]


class Finder:
    """Windows that hold enough of a template, titles and identifiers in the words of many texts."""

    def __init__(self, grams: list[tuple[int, np.ndarray]], c: Licences):
        self.c, self.family = c, np.array([k for k, _ in grams])
        self.size = np.array([len(g) for _, g in grams])
        self.need = np.ceil(c.least_overlap * self.size - 1e-9).astype(np.int64)
        # Words may be put in, as names or the marks of comments.
        self.reach = self.size + self.size // 4 + 5
        pair, template = np.concatenate([g for _, g in grams]), np.repeat(np.arange(len(grams)), self.size)
        order = np.argsort(pair, kind="stable")
        self.pairs, self.first, self.uses = np.unique(pair[order], return_index=True, return_counts=True)
        self.templates = template[order]
        one = lambda text: words_of(*_lines([text]))
        self.titles = {int(self._rows(*one(x))[0]): k for k, f in enumerate(FAMILIES) for x in TITLES[f]}
        self.ids = {int(one(x)[0][0]): k for k, f in enumerate(FAMILIES) for x in SPDX[f]}
        self.tagged = {int(one(f"{SPDX_TAG}:{x}")[0][0]): k for k, f in enumerate(FAMILIES) for x in SPDX[f]}
        self.tag = one(SPDX_TAG)[0][0]
        self.title_hashes, self.tagged_hashes = (np.array(sorted(x), np.uint64) for x in (self.titles, self.tagged))

    @staticmethod
    def _rows(words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A hash of each line's word sequence."""
        at = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words ^ mix(at.astype(np.uint64) + np.uint64(1))), dtype=np.uint64)])
        return mix(sums[first[1:]] - sums[first[:-1]])

    def named(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """First word, end and family of titles and identifiers."""
        rows = self._rows(words, first)
        for line in _members(rows, self.title_hashes):
            yield int(first[line]), int(first[line + 1]), self.titles[int(rows[line])]
        for at in _members(words, self.tagged_hashes):
            yield int(at), int(at) + 1, self.tagged[int(words[at])]
        for at in np.flatnonzero(words == self.tag):
            end = int(first[np.searchsorted(first, at, "right")])
            for k in range(int(at) + 1, end):
                if (family := self.ids.get(int(words[k]))) is not None:
                    yield k, k + 1, family

    def windows(self, words: np.ndarray, paragraph: np.ndarray) -> list[tuple[int, int, int, float, int]]:
        """First word, end, family, share of the template and pairs of it, for every window that holds enough."""
        pairs = _pairs(words)
        at = _members(pairs, self.pairs)
        at = at[paragraph[at] == paragraph[at + 1]]
        if not len(at):
            return []
        known = np.searchsorted(self.pairs, pairs[at])
        uses = self.uses[known]
        template = self.templates[ragged(self.first[known], uses)]
        at, known = np.repeat(at, uses), np.repeat(known, uses)
        # Places, with gaps between paragraphs that no window reaches across.
        place = at + paragraph[at] * (int(self.reach.max()) + 1)
        order = np.lexsort((place, template))
        at, known, template, place = at[order], known[order], template[order], place[order]
        key = template * (int(place.max()) + int(self.reach.max()) + 2) + place
        end = np.searchsorted(key, key + self.reach[template])
        out = []
        for i in np.flatnonzero(end - np.arange(len(key)) >= self.need[template]):
            kind, fresh = template[i], np.unique(known[i : end[i]], return_index=True)[1]
            if len(fresh) >= self.need[kind]:
                last = at[i + int(fresh.max())]
                out.append((int(at[i]), int(last) + 2, int(self.family[kind]), len(fresh) / int(self.size[kind]), len(fresh)))
        return out


def notices(m: Model, finder: Finder, words: np.ndarray, first: np.ndarray, breaks: np.ndarray) -> list[tuple[int, int, int, float, float]]:
    """First word, end, family, probability and overlap of the notices in lines; of overlapping ones the best.

    ``breaks`` marks lines that start another text.
    """
    c, line = finder.c, np.repeat(np.arange(len(first) - 1), np.diff(first))
    paragraph = np.cumsum((np.diff(first) == 0) | breaks)[line]
    found = [(a, b, k, 1.0, 1.0, b - a) for a, b, k in finder.named(words, first)]
    windows = finder.windows(words, paragraph) if len(words) > 1 else []
    for i in range(0, len(windows), 1 << 12):
        some = windows[i : i + (1 << 12)]
        starts, ends = np.array([w[0] for w in some]), np.array([w[1] for w in some])
        chance = _chances(m, words[ragged(starts, ends - starts)], np.concatenate([[0], np.cumsum(ends - starts)]), c)
        best, sure = chance.argmax(1), chance.max(1)
        found += [
            (a, b, k, float(sure[j]), part, n) for j, (a, b, k, part, n) in enumerate(some) if best[j] == k and sure[j] >= c.least_probability
        ]
    taken, out = np.zeros(len(words), bool), []
    for a, b, k, sure, part, _ in sorted(found, key=lambda x: (-x[4], -x[5], x[1] - x[0], x[0], x[2])):
        if not taken[a:b].any():
            taken[a:b] = True
            out.append((a, b, k, sure, part))
    return sorted(out)


def _scanned(model, c: Licences):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        finder = Finder(m.grams, c)
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            docs, numbers, families, sure, alike = [], [], [], [], []
            for i, j in slices(bounds, 1 << 20):
                own, edges = data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
                breaks = np.flatnonzero(own == 10)
                lines = np.unique(np.concatenate([edges, breaks + 1]))
                words, first = words_of(own, lines)
                seen = set()
                for a, _, k, chance, part in notices(m, finder, words, first, np.isin(lines[:-1], edges)):
                    at = lines[np.searchsorted(first, a, "right") - 1]
                    doc = int(np.searchsorted(edges, at, "right")) - 1
                    number = int(np.searchsorted(breaks, at) - np.searchsorted(breaks, edges[doc]))
                    if (doc, number, k) in seen:
                        continue
                    seen.add((doc, number, k))
                    docs.append(i + doc)
                    numbers.append(number)
                    families.append(FAMILIES[k])
                    sure.append(chance)
                    alike.append(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(docs, pa.int64())), pa.array(numbers, pa.int64()), pa.array(families, pa.string()),
                 pa.array(sure, pa.float64()), pa.array(alike, pa.float64())],
                names=["doc_id", "line", "family", "probability", "overlap"],
            )

    return run


def scan_licences(docs: DataFrame, licences: Licences = Licences()) -> DataFrame:
    """One row per licence notice of ``docs``: doc_id, line (from 0) where it starts, family, probability, overlap.

    ``docs`` needs ``doc_id`` and ``text``; further columns are ignored. A notice lies in one paragraph, a run of lines
    that hold words, and may be wrapped or stand among other words; several are several rows, but one for each line and
    family. Titles and SPDX identifiers have probability and overlap 1. Null and empty texts give no rows; repeated rows
    give repeated rows. An empty table gives no rows.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    model = fit(corpus_sample(docs, licences), licences)
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(
        _scanned(held, licences), f"doc_id {kind}, line long, family string, probability double, overlap double"
    )
