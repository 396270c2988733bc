"""Licence families of paragraphs by a sparse n-gram classifier, confirmed by template comparison.

A paragraph's word 1-, 2- and 3-grams are hashed into buckets; a multinomial logistic regression
over them, trained here in numpy, gives the probability of each family and of none (unknown). Its
temperature is calibrated on variants held back from training, and a family is only stated at
`LEAST_PROBABILITY` or more; everything else is unknown. A stated family is confirmed by the share
of its best template's word 2-grams that the paragraph holds, which must reach `LEAST_SHARE` and pass
that of every other family.

Positive examples are variants of the families' notices and granting texts (case, punctuation, lost and
added words); examples of the unknown class are a bounded sample of the corpus's own lines (of the
documents with the smallest hash of their key in each of `SAMPLE` classes of that hash, `LINES` lines of
up to `LINE_CHARS` characters, the smallest by hash), less those near a template. Families and their texts
are a parameter (`Templates`). Scoring covers every line of every text, and every stretch of a paragraph,
however its lines are wrapped and commented, that holds `LEAST_SHARE` of a template's word pairs. A
paragraph ends at a line without words. A statement found as a line and as a stretch gives one row.

Defined cases: a null text counts as empty; an empty text has no paragraphs and no rows; repeated
rows are scanned each, and train once; paragraphs may be of any length; without corpus examples the
unknown class is trained on shuffled template words alone. Extra columns are ignored.
"""

from __future__ import annotations

import random
import re
from bisect import bisect, insort
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import documents, text_of

#: Notices and granting texts by which the families are stated; fixed values. `Templates` adds the tag lines.
TEMPLATES = {
    "0BSD": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
             "Licensed under the Zero-Clause BSD license"],
    "AFL-3.0": ["Licensed under the Academic Free License version 3.0"],
    "AGPL-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
                 "Licensed under the GNU Affero General Public License, version 3"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."],
    "Artistic-2.0": ["Licensed under the Artistic License 2.0",
                     "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. This license establishes the terms under which a given free software Package may be copied, modified, distributed, and/or redistributed."],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License", "Released under the Simplified BSD License",
                     "This software is released under the two-clause BSD license"],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
                     "Use of this source code is governed by a BSD-style license", "Licensed under the BSD 3-Clause License",
                     "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0",
                "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software"],
    "BUSL-1.1": ["Use of this software is governed by the Business Source License", "Licensed under the Business Source License 1.1",
                 "On the date above, in accordance with the Business Source License, use of this software will be governed by the Change License"],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License", "Licensed under CC BY 4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["This work is marked with CC0 1.0 Universal", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
                "Released under the Creative Commons Zero v1.0 Universal dedication"],
    "CDDL-1.0": ["The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\"). You may not use this file except in compliance with the License.",
                 "Licensed under the Common Development and Distribution License, Version 1.0"],
    "ECL-2.0": ["Licensed under the Educational Community License, Version 2.0"],
    "EPL-1.0": ["All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution",
                "Licensed under the Eclipse Public License 1.0"],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
                "Licensed under the Eclipse Public License 2.0"],
    "EUPL-1.2": ["Licensed under the EUPL, Version 1.2 or, as soon they will be approved by the European Commission, subsequent versions of the EUPL",
                 "Licensed under the European Union Public Licence 1.2"],
    "Elastic-2.0": ["Licensed under the Elastic License 2.0", "you may not use this file except in compliance with the Elastic License 2.0"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
            "Released under the ISC License"],
    "LGPL-2.1": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
                 "Licensed under the GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
                 "Licensed under the GNU Lesser General Public License, version 3"],
    "MIT": ["Released under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
            "Licensed under the MIT license"],
    "MPL-1.1": ["The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License 2.0"],
    "MS-PL": ["This source is subject to the Microsoft Public License", "Licensed under the Microsoft Public License"],
    "ODbL-1.0": ["This database is made available under the Open Database License", "Any rights in individual contents of the database are licensed under the Database Contents License"],
    "OFL-1.1": ["This Font Software is licensed under the SIL Open Font License, Version 1.1"],
    "PSF-2.0": ["Licensed under the Python Software Foundation License Version 2",
                "This LICENSE AGREEMENT is between the Python Software Foundation, and the Individual or Organization accessing and otherwise using this software in source or binary form and its associated documentation"],
    "PostgreSQL": ["Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.",
                   "Released under the PostgreSQL License"],
    "SSPL-1.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the Server Side Public License, version 1",
                 "Licensed under the Server Side Public License"],
    "UPL-1.0": ["Licensed under the Universal Permissive License v 1.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.",
                  "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
             "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"],
}
TAG = "SPDX-License-Identifier:"
WORD = re.compile(r"\w+")
#: Comment marks that are words; all others are no part of a word.
MARK = re.compile(r"\s*(?:dnl|rem)\b", re.I)
BUCKET_BITS, ORDERS = 18, 3
VARIANTS, SAMPLE, EPOCHS = 80, 500, 30
LINES, LINE_CHARS = 2000, 4096
NEIGHBOURS = 4096
#: N-grams whose weights are held at once.
GATHERED = 1 << 17
LEAST_PROBABILITY, LEAST_SHARE = 0.8, 0.6
HELD_WORDS = 1 << 18


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Grams:
    """Hashed n-grams of paragraphs, through a bounded table of word hashes."""

    def __init__(self) -> None:
        self.held: dict[str, int] = {}

    def of(self, paragraphs: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(paragraph, bucket) of every n-gram, by order and paragraph."""
        held, shift = self.held, np.uint64(64 - BUCKET_BITS)
        if len(held) > HELD_WORDS:
            held.clear()
        for w in set(chain.from_iterable(paragraphs)):
            if w not in held:
                held[w] = xxhash.xxh64_intdigest(w)
        sizes = np.asarray([len(p) for p in paragraphs], np.int64)
        h = np.fromiter(map(held.__getitem__, chain.from_iterable(paragraphs)), np.uint64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(paragraphs)), sizes)
        out, key = [(owner, (h >> shift).astype(np.int64))], h
        for order in range(1, min(ORDERS, len(h))):
            n = len(h) - order
            key = key[:n] * np.uint64(0x9E3779B97F4A7C15) + h[order:]
            inside = owner[:n] == owner[order:]
            out.append((owner[:n][inside], (key[inside] >> shift).astype(np.int64)))
        return out


def pair_set(words: list[str]) -> set:
    return set(zip(words, words[1:], strict=False)) or set(words)


class Templates:
    """The families and what compares a paragraph with their texts."""

    def __init__(self, texts: Mapping[str, list[str]] = TEMPLATES) -> None:
        self.families = sorted(texts)
        self.texts = {f: [*texts[f], *self.tags(f)] for f in self.families}
        self.pairs = {f: [pair_set(words_of(t)) for t in self.texts[f]] for f in self.families}
        #: Every template's pairs and the most words that a stretch with its notice spans.
        self.spans = [(pair_set(w), 2 * len(w) + 8) for f in self.families for w in map(words_of, self.texts[f])]
        self.owners = [f for f in self.families for _ in self.texts[f]]
        self.holders: dict[tuple, list[int]] = defaultdict(list)
        for i, (pairs, _) in enumerate(self.spans):
            for pair in pairs:
                self.holders[pair].append(i)

    @staticmethod
    def tags(family: str) -> list[str]:
        """The family as it is named in a tag line."""
        ends = ["-only", "-or-later"] if "GPL" in family else [""]
        return [f"{TAG} {family}{end}" for end in ends]

    def share(self, words: list[str], family: str) -> float:
        """The largest share of a template's word pairs that the paragraph holds."""
        own = pair_set(words)
        return max(len(own & t) / len(t) for t in self.pairs[family])

    def evidence(self, words: list[str], family: str) -> set:
        """The pairs of the family's best template that the paragraph holds."""
        own = pair_set(words)
        best = max(self.pairs[family], key=lambda t: (len(own & t) / len(t), len(t)))
        return own & best

    def told(self, words: list[str], family: str) -> set:
        """The paragraph's pairs that stand in any text of the family."""
        return pair_set(words).intersection(chain.from_iterable(self.pairs[family]))

    def nearest(self, words: list[str], but: str | None = None) -> tuple[float, int]:
        """The largest share that any family (or any `but` one) has, and the pairs behind it."""
        counts = Counter(chain.from_iterable(self.holders.get(pair, ()) for pair in pair_set(words)))
        return max(((n / len(self.spans[i][0]), n) for i, n in counts.items() if self.owners[i] != but), default=(0.0, 0))

    def confirms(self, words: list[str], family: str) -> bool:
        """Whether the paragraph is nearer to the family's texts than to any other's. Of two texts that it
        holds alike the longer one counts; what two families say alike is neither's."""
        share = self.share(words, family)
        return share >= LEAST_SHARE and (share, len(self.evidence(words, family))) > self.nearest(words, family)

    def held_by(self, pairs: list[tuple]) -> list[tuple[set, int]]:
        """The templates of which the pairs hold `LEAST_SHARE`, with their spans."""
        present = self.holders.keys() & pairs
        counts = Counter(chain.from_iterable(map(self.holders.__getitem__, present)))
        return [self.spans[i] for i, n in sorted(counts.items()) if n >= LEAST_SHARE * len(self.spans[i][0])]


def unmarked(line: str) -> str:
    """The line with a leading comment mark that is a word blanked out; no character moves."""
    mark = MARK.match(line)
    return " " * mark.end() + line[mark.end():] if mark else line


def stretches(words: list[str], templates: Templates) -> set[tuple[int, int]]:
    """(first word, end) of the tightest stretches that hold `LEAST_SHARE` of a template's pairs."""
    pairs, out = list(zip(words, words[1:], strict=False)), set()
    for template, most in templates.held_by(pairs):
        hits = [i for i, p in enumerate(pairs) if p in template]
        held, left, spans = Counter(), 0, []
        for i in hits:
            held[pairs[i]] += 1
            while i + 2 - hits[left] > most or held[pairs[hits[left]]] > 1:
                first = pairs[hits[left]]
                held[first] -= 1
                if not held[first]:
                    del held[first]
                left += 1
            if len(held) >= LEAST_SHARE * len(template):
                spans.append((-len(held), i + 2 - hits[left], hits[left]))
        taken = []
        for _, size, first in sorted(spans):
            at = bisect(taken, (first, first + size))
            if (not at or taken[at - 1][1] <= first) and (at == len(taken) or first + size <= taken[at][0]):
                insort(taken, (first, first + size))
        out.update(taken)
    return out


def passages(body: str, templates: Templates) -> Iterator[tuple[int, int, list[str], bool]]:
    """(start, length, words, whether it is a line) of every line with words, and of every stretch of
    a paragraph that holds a template's notice."""
    start, block, words = 0, 0, []
    for line in [*body.split("\n"), ""]:
        own = words_of(line)
        if own:
            yield start, len(line), own, True
        if MARK.match(line):
            own = words_of(unmarked(line))
        if not own:
            if templates.held_by(list(zip(words, words[1:], strict=False))):
                # lower case may have other places, so words are found anew with theirs
                text = "\n".join(map(unmarked, body[block:start].split("\n")))
                found = [(m.start(), m.end(), m.group().lower()) for m in WORD.finditer(text)]
                for first, end in sorted(stretches([w for *_, w in found], templates)):
                    yield block + found[first][0], found[end - 1][1] - found[first][0], [w for *_, w in found[first:end]], False
            words, block = [], start + len(line) + 1
        words += own
        start += len(line) + 1


def kept_statements(found: list[tuple], templates: Templates) -> list[tuple]:
    """Of the (start, length, family, probability, share, confirmed, words, whether it is a line) of a
    text, each statement once: that of the best share, of equal ones the line, then the longest stretch, as a
    notice may hold another family's whole."""
    kept = defaultdict(list)  # by stretch of the text, so that a statement is compared with its neighbours only

    def blocks(f: tuple) -> range:
        return range(f[0] // NEIGHBOURS, (f[0] + f[1]) // NEIGHBOURS + 1)

    def meeting(f: tuple) -> Iterator[tuple]:
        for block in blocks(f):
            yield from ((k, told) for k, told in kept[block] if f[0] < k[0] + k[1] and k[0] < f[0] + f[1])

    out = []
    for f in sorted((f for f in found if f[5]), key=lambda f: (-f[4], not f[-1], -f[1], f[0])):
        own = templates.evidence(f[6], f[2])
        # less than half of what speaks for it is anything but the other statement's
        if not any(k[2] == f[2] or 2 * len(own - told) < len(own) for k, told in meeting(f)):
            out.append(f)
            told = templates.told(f[6], f[2])
            for block in blocks(f):
                kept[block].append((f, told))
    out += [f for f in found if f[-1] and not f[5] and not any(k[2] == f[2] for k, _ in meeting(f))]
    return sorted(out, key=lambda f: f[:2])


@dataclass
class Classifier:
    """Weights of the buckets that occurred in training; `index` gives their row, -1 for all others. The
    last column is the unknown class."""

    templates: Templates
    index: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, grams: list[tuple], count: int) -> np.ndarray:
        """Sums of weights over the n-grams, over the root of their number."""
        total, size = np.zeros((count, len(self.bias)), np.float32), np.zeros(count, np.int64)
        for owner, bucket in grams:
            size += np.bincount(owner, minlength=count)
            row = self.index[bucket]
            owner, row = owner[row >= 0], row[row >= 0]
            for at in range(0, len(row), GATHERED):
                own = owner[at:at + GATHERED]
                starts = np.flatnonzero(np.diff(own, prepend=-1))
                total[own[starts]] += np.add.reduceat(self.weights[row[at:at + GATHERED]], starts)
        return total / np.sqrt(np.maximum(size, 1))[:, None].astype(np.float32) + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def variants(texts: list[str], count: int, rng: random.Random, around: list[str]) -> list[list[str]]:
    """Notices as they are found: words lost, added, or standing in other text."""
    out = []
    for i in range(count):
        words = words_of(texts[i % len(texts)])
        if i >= len(texts):
            words = [w for w in words if rng.random() > 0.06] or words
            if around and rng.random() < 0.4:
                words = [rng.choice(around) for _ in range(rng.randrange(6))] + words + [rng.choice(around) for _ in range(rng.randrange(6))]
        out.append(words)
    return out


def train(unknown: list[list[str]], templates: Templates | None = None, seed: int = 5) -> Classifier:
    """Fit on template variants and unknown paragraphs; a fifth is held back for the temperature."""
    templates, rng = templates or Templates(), random.Random(seed)
    classes = len(templates.families) + 1
    pool = list(chain.from_iterable(unknown))
    every = [w for texts in templates.texts.values() for t in texts for w in words_of(t)]
    none = [rng.sample(every, rng.randrange(2, 12)) for _ in range(2 * VARIANTS)]
    none += [[*words_of(TAG), *rng.choices(pool or every, k=rng.randrange(1, 4))] for _ in range(VARIANTS)]
    data = [(w, k) for k, f in enumerate(templates.families) for w in variants(templates.texts[f], VARIANTS, rng, pool)]
    data += [(w, classes - 1) for w in unknown + none]
    rng.shuffle(data)
    grams, labels = Grams().of([w for w, _ in data]), np.asarray([k for _, k in data])
    known = np.unique(np.concatenate([bucket for _, bucket in grams]))
    index = np.full(1 << BUCKET_BITS, -1, np.int32)
    index[known] = np.arange(len(known))
    model = Classifier(templates, index, np.zeros((len(known), classes), np.float32), np.zeros(classes, np.float32))
    held = np.arange(len(data)) % 5 == 4
    owner, row = np.concatenate([o for o, _ in grams]), index[np.concatenate([b for _, b in grams])]
    order = np.argsort(row, kind="stable")
    order = order[~held[owner[order]]]
    fo, fr = owner[order], row[order]
    starts = np.flatnonzero(np.diff(fr, prepend=-1))
    size = np.maximum(np.bincount(owner, minlength=len(data)), 1)
    target = np.eye(classes, dtype=np.float32)[labels]
    squares, rarity = np.full((len(starts), 1), 1e-3, np.float32), 1 / np.bincount(labels, minlength=classes)[labels]
    for _ in range(EPOCHS):  # full-batch Adagrad: the training set is a few thousand short paragraphs
        slope = (model.probabilities(model.logits(grams, len(data))) - target) * rarity[:, None].astype(np.float32)
        slope[held] = 0
        grad = np.add.reduceat((slope / np.sqrt(size)[:, None].astype(np.float32))[fo], starts)
        squares += (grad * grad).mean(1, keepdims=True)
        model.weights[fr[starts]] -= 0.6 * grad / np.sqrt(squares)
        model.bias -= 0.3 * slope.sum(0)
    back = model.logits(grams, len(data))[held]
    losses = []
    for t in np.linspace(0.1, 3, 59):
        model.temperature = float(t)
        p = model.probabilities(back)[np.arange(held.sum()), labels[held]]
        losses.append((-np.log(np.maximum(p, 1e-12)).mean(), float(t)))
    model.temperature = min(losses)[1]
    return model


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE, lines: int = LINES,
        templates: Templates | None = None) -> Classifier:
    """The classifier for a corpus. At most `lines` lines of `LINE_CHARS` characters reach the driver."""
    templates = templates or Templates()
    keyed = docs.select(F.xxhash64(F.col(f"`{key}`")).alias("h"), text_of(text).alias("body"))
    least = keyed.groupBy(F.pmod("h", F.lit(sample)).alias("c")).agg(F.min("h").alias("h")).select("h")  # `sample` rows at most
    found = (keyed.join(F.broadcast(least), "h", "left_semi").select("h", F.explode(F.split("body", "\n")).alias("line"))
             .where((F.char_length("line") <= LINE_CHARS) & F.col("line").rlike(r"\S")).distinct())
    drawn = found.orderBy(F.xxhash64("h", "line"), "h", "line").limit(lines).collect()
    unknown = [w for w in (words_of(r["line"]) for r in drawn) if w]
    return train([w for w in unknown if templates.nearest(w)[0] < 0.3], templates)


def scan(docs: DataFrame, model: Classifier, text: str = "text", key: str = "doc_id", rows_at_once: int = 128) -> DataFrame:
    """One row per line or stretch that states a family: key, start (character), length, family, probability, share, confirmed."""
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), text_of(text).alias("text"))
    names = ["doc_id", "start", "length", "family", "probability", "share", "confirmed"]

    templates = model.templates
    none = len(templates.families)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            for at in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(at, rows_at_once)
                place, found = [], []
                for row, body in enumerate(part.column(1).to_pylist()):
                    for start, length, words, line in passages(body, templates):
                        place.append((row, start, length, line))
                        found.append(words)
                p = model.probabilities(model.logits(grams.of(found), len(found))) if found else np.zeros((0, none + 1))
                best, stated = p.argmax(1), defaultdict(list)
                for i in np.flatnonzero((best != none) & (p.max(1, initial=0) >= LEAST_PROBABILITY)):
                    family, (row, start, length, line) = templates.families[best[i]], place[i]
                    share = templates.share(found[i], family)
                    sure = templates.confirms(found[i], family)
                    stated[row].append((start, length, family, round(float(p[i, best[i]]), 6), share, sure, found[i], line))
                out = [(row, *f[:6]) for row, some in stated.items() for f in kept_statements(some, templates)]
                cols = list(zip(*out, strict=True)) or [[]] * 7
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(list(cols[0]), pa.int64())),
                     *(pa.array(list(c), k) for c, k in zip(cols[1:], kinds, strict=True))], names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, start long, length long, family string, probability double, "
                                "share double, confirmed boolean")


def op5_license_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All confirmed licence statements of all documents."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return scan(docs, fit(docs)).where("confirmed").drop("confirmed")
