"""License scans: a trained paragraph classifier whose predictions templates must confirm.

Every paragraph (the words between blank lines, its lines joined without their comment marks; a long
one in overlapping windows of ``WINDOW`` words) is turned into the word n-grams (one to three words)
that occur in any licence template. A multinomial logistic
regression over these sparse features predicts the licence family or ``unknown``. Its probabilities
are calibrated by a temperature fitted on held-out rows, and a family is accepted only from
``least_probability``. An accepted prediction is confirmed if a template of that family has
``least_overlap`` of its three-word shingles and all of its numbers in the window, and the window holds
a word of the family's own if all its templates do (``affero``). Templates are passages of the licences' texts,
notices that name a licence, SPDX lines, and, in a paragraph of at most ``SHORT`` words, the names by
themselves. Every other family whose template is in the window
is judged by the template's stretch alone, so one window can confirm several families.

Training rows are variants of the templates (spans, dropped words, surrounding text) and, as
``unknown``, paragraphs of a bounded, documented sample: ``sample_docs`` documents drawn by a hash of
their id. Paragraphs of the sample that a template confirms are left out. Scoring covers every
paragraph of every text.

Edge cases: a null or empty text has no paragraphs and no licence; ties go to the family that sorts
first; repeated rows repeat their result; an empty table gives an empty result (the model then
learns from the templates alone); other columns are not read.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 64
STRIDE = 32
UNKNOWN = "unknown"
_WORD = re.compile("[0-9a-z]+")
# What stands before a line's words in source comments; a line of nothing else is blank.
_MARKS = re.compile(r"""[\s#*/;%!|<>"'{}()\\.=~+_-]*(?:(?:dnl|rem)\b[\s#*/;%!|<>-]*)?""", re.I)

# Passages of the licences' texts and notices, by family.
PASSAGES: dict[str, list[str]] = {
    "agpl-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an \"AS IS\" BASIS",
        "Apache License Version 2.0, January 2004",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to "
        "You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright "
        "license to reproduce, prepare Derivative Works of",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution",
        "may be used to endorse or promote products derived from this software without specific "
        "prior written permission",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    ],
    "cc-by-3.0": [
        "This work is licensed under a Creative Commons Attribution 3.0 Unported License",
    ],
    "cc-by-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "cc-by-nc-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License",
    ],
    "cc-by-sa-3.0": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License",
    ],
    "cc-by-sa-4.0": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License",
    ],
    "cc0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work",
        "released under CC0 1.0 Universal",
    ],
    "epl-2.0": [
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "either version 2 of the License, or (at your option) any later version",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "either version 3 of the License, or (at your option) any later version",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
        "THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS",
    ],
    "lgpl": [
        "licensed under the GNU Lesser General Public License",
        "under the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation",
        "GNU Lesser General Public License version 2.1",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
        "to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so",
        "The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means",
    ],
    "zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software",
    ],
}
# The families' names in notices, and their identifiers in SPDX lines.
NAMES: dict[str, list[str]] = {
    "agpl-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL v3"],
    "apache-2.0": ["Apache License 2.0", "Apache License, Version 2.0"],
    "bsd": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License"],
    "cc-by-3.0": ["CC BY 3.0"],
    "cc-by-4.0": ["CC BY 4.0"],
    "cc-by-nc-4.0": ["CC BY-NC 4.0"],
    "cc-by-sa-3.0": ["CC BY-SA 3.0"],
    "cc-by-sa-4.0": ["CC BY-SA 4.0"],
    "cc0-1.0": ["CC0 1.0 Universal"],
    "epl-2.0": ["Eclipse Public License 2.0"],
    "gpl-2.0": ["GNU General Public License, version 2", "GNU GPL v2"],
    "gpl-3.0": ["GNU General Public License, version 3", "GNU GPL v3"],
    "isc": ["ISC License"],
    "lgpl": ["GNU Lesser General Public License"],
    "mit": ["MIT License", "The MIT License (MIT)"],
    "mpl-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0"],
    "unlicense": ["The Unlicense"],
    "zlib": ["zlib License"],
}
SPDX: dict[str, list[str]] = {
    "agpl-3.0": ["AGPL-3.0"], "apache-2.0": ["Apache-2.0"],
    "bsd": ["BSD-2-Clause", "BSD-3-Clause"], "cc-by-3.0": ["CC-BY-3.0"], "cc-by-4.0": ["CC-BY-4.0"],
    "cc-by-nc-4.0": ["CC-BY-NC-4.0"], "cc-by-sa-3.0": ["CC-BY-SA-3.0"],
    "cc-by-sa-4.0": ["CC-BY-SA-4.0"], "cc0-1.0": ["CC0-1.0"], "epl-2.0": ["EPL-2.0"],
    "gpl-2.0": ["GPL-2.0"], "gpl-3.0": ["GPL-3.0"], "isc": ["ISC"], "lgpl": ["LGPL-2.1", "LGPL-3.0"],
    "mit": ["MIT"], "mpl-2.0": ["MPL-2.0"], "unlicense": ["Unlicense"], "zlib": ["Zlib"],
}
# A notice says one of these of a name.
FORMS = ["Licensed under {}", "Licensed under the {}", "Released under the {}",
         "This project is licensed under the {}", "Distributed under the terms of the {}"]
# The licences' passages, and their names in every form. A name by itself counts in a short
# paragraph (a heading), not in running text.
TEMPLATES: dict[str, list[str]] = {
    f: PASSAGES[f] + [form.format(n) for n in NAMES[f] for form in FORMS]
    + [f"SPDX-License-Identifier: {i}" for i in SPDX[f]] for f in sorted(PASSAGES)}
SHORT = 12  # words of a paragraph in which a name by itself is a notice

GNU, OTHER_GNU = ("gpl-2.0", "gpl-3.0"), ("agpl-3.0", "lgpl")
GNU_NAME = ("gnu", "general", "public")


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def paragraphs(text: str | None) -> Iterator[str]:
    """The runs of lines between blank lines, without comment marks."""
    held: list[str] = []
    for line in (text or "").split("\n"):
        line = line[_MARKS.match(line).end():]
        if line:
            held.append(line)
        elif held:
            yield "\n".join(held)
            held = []
    if held:
        yield "\n".join(held)


def grams(words: list[str], least: int = 1) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + n]) for n in range(least, 4) for i in range(len(words) - n + 1)}


def windows(words: list[str]) -> Iterator[list[str]]:
    if len(words) <= WINDOW:
        yield words
        return
    for at in range(0, len(words) - STRIDE, STRIDE):
        yield words[at:at + WINDOW]


class Classifier:
    """Weights by n-gram and family, the temperature and the templates' shingles."""

    def __init__(self, background: list[str], seed: int = 11, rounds: int = 120):
        self.families = sorted(TEMPLATES) + [UNKNOWN]
        texts = {f: [tokens(t) for t in TEMPLATES[f]] for f in sorted(TEMPLATES)}
        names = {f: [tokens(n) for n in NAMES[f]] for f in texts}
        # (family, shingles, is it a name by itself); a text of two words is one shingle.
        # Versions tell families apart: all numbers of a template must be there.
        self.templates = [(f, frozenset(grams(t, min(3, len(t)))), kind,
                           frozenset((w,) for w in t if w.isdigit()))
                          for f in texts for kind, own in ((False, texts[f]), (True, names[f]))
                          for t in own]
        self.holders: dict[tuple, list[int]] = {}
        for i, (_, own, _, _) in enumerate(self.templates):
            for g in own:
                self.holders.setdefault(g, []).append(i)
        # Words of a family's names that no other family's have, as "affero". If all its passages hold
        # one too, a text of that family does.
        said = {f: set().union(*names[f], *(tokens(i) for i in SPDX[f])) for f in texts}
        self.own = {f: said[f].difference(*(said[g] for g in texts if g != f)) for f in texts}
        self.marked = {f: self.own[f] if all(self.own[f] & set(tokens(p)) for p in PASSAGES[f])
                       else set() for f in texts}
        known = sorted(set().union(*(grams(t) for own in texts.values() for t in own)))
        self.index = {g: i for i, g in enumerate(known)}
        self.single = {g[0] for g in known if len(g) == 1}
        background = [w for t in background for w in windows(tokens(t))
                      if not any(share >= 0.7 for _, share, _ in self.shares(self.found(w), True))]
        rows, labels = self._variants(texts, background, random.Random(seed))
        x = np.zeros((len(rows), len(known)), np.float32)
        for i, r in enumerate(rows):
            x[i, list(self.features(r))] = 1
        y = np.array(labels)
        held = np.arange(len(y)) % 4 == 3
        self.weights, self.bias = self._fit(x[~held], y[~held], len(self.families), rounds)
        self.temperature = self._calibrate(x[held], y[held])
        # The most that a feature can speak for any family against unknown.
        self.margin = (self.weights[:, :-1].max(1) - self.weights[:, -1]).tolist()
        self.base = float((self.bias[:-1] - self.bias[-1]).max())

    def shares(self, found: set, short: bool) -> list[tuple[str, float, frozenset]]:
        """(family, share of its shingles found, its shingles) of the templates that share any; names
        by themselves only in a short text."""
        hits: dict[int, int] = {}
        for g in found:
            for i in self.holders.get(g, ()):
                hits[i] = hits.get(i, 0) + 1
        return [(f, n / len(own), own) for i, n in sorted(hits.items())
                for f, own, name, numbers in [self.templates[i]]
                if (short or not name) and numbers <= found]

    def _variants(self, texts, background, rand) -> tuple[list[list[str]], list[int]]:
        rows, labels = [], []
        filler = background or [["text"]]
        for k, family in enumerate(self.families[:-1]):
            for t, words in enumerate(texts[family]):
                for i in range(48 if t < len(PASSAGES[family]) else 12):
                    own = list(words)
                    if i % 3 == 1 and len(own) > 12:
                        at = rand.randrange(len(own) - 10)
                        own = own[at:at + rand.randint(10, len(own))]
                    elif i % 3 == 2:
                        own = [w for w in own if rand.random() > 0.05]
                    if i % 2:
                        some = rand.choice(filler)
                        cut = rand.randrange(len(some) + 1)
                        own = some[:cut][-30:] + own + some[cut:][:30]
                    rows.append(own)
                    labels.append(k)
            for name in map(tokens, NAMES[family]):  # headings
                for i in range(12):
                    rows.append(rand.choice(filler)[:i % 4] + name)
                    labels.append(k)
        for words in background:
            rows.append(words)
            labels.append(len(self.families) - 1)
        # Short pieces that several families share say nothing on their own.
        for family in self.families[:-1]:
            for words in texts[family]:
                for _ in range(6):
                    at = rand.randrange(len(words))
                    piece = words[at:at + rand.randint(1, 2)]
                    if self.own[family].isdisjoint(piece):
                        rows.append(piece + rand.choice(filler)[:30])
                        labels.append(len(self.families) - 1)
        order = list(range(len(rows)))
        rand.shuffle(order)
        return [rows[i] for i in order], [labels[i] for i in order]

    @staticmethod
    def _fit(x, y, n, rounds) -> tuple[np.ndarray, np.ndarray]:
        w, b = np.zeros((x.shape[1], n), np.float32), np.zeros(n, np.float32)
        target = np.eye(n, dtype=np.float32)[y]
        mw, vw = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, rounds + 1):
            p = _softmax(x @ w + b)
            gap = (p - target) / len(y)
            g = x.T @ gap + 1e-5 * w
            mw, vw = 0.9 * mw + 0.1 * g, 0.99 * vw + 0.01 * g * g
            w -= 0.05 * (mw / (1 - 0.9 ** t)) / (np.sqrt(vw / (1 - 0.99 ** t)) + 1e-8)
            b -= 0.5 * gap.sum(0)
        return w, b

    def _calibrate(self, x, y) -> float:
        logits = x @ self.weights + self.bias
        def loss(t: float) -> float:
            return float(-np.log(_softmax(logits / t)[np.arange(len(y)), y] + 1e-9).mean())

        return min((0.25, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0, 4.0), key=loss) if len(y) else 1.0

    def found(self, words: list[str]) -> set[tuple[str, ...]]:
        """The template n-grams among the n-grams of these words."""
        out, run = set(), []
        single, index = self.single, self.index
        for w in words:
            if w not in single:
                run.clear()
                continue
            run.append(w)
            for n in range(1, min(3, len(run)) + 1):
                g = tuple(run[-n:])
                if g in index:
                    out.add(g)
        return out

    def features(self, words: list[str]) -> set[int]:
        return {self.index[g] for g in self.found(words)}

    def judge(self, words: list[str]) -> tuple[str, float, float] | None:
        """(family, probability, template overlap); None for unknown."""
        if self.single.isdisjoint(words):
            return None
        found = self.found(words)
        return self._predict(found, self.shares(found, len(words) <= SHORT))

    def _predict(self, found: set, shares: list) -> tuple[str, float, float] | None:
        own = [self.index[g] for g in found]
        if self.base + sum(m for i in own if (m := self.margin[i]) > 0) <= 0:
            return None
        p = _softmax((self.weights[own].sum(0) + self.bias)[None] / self.temperature)[0]
        k = int(p.argmax())
        if k == len(self.families) - 1:
            return None
        family = self.families[k]
        return family, float(p[k]), max((n for f, n, _ in shares if f == family), default=0.0)

    def confirms(self, said: tuple[str, float, float], words: list[str],
                 least_overlap: float) -> bool:
        marked = self.marked[said[0]]
        return said[2] >= least_overlap and not (marked and marked.isdisjoint(words))

    def verdicts(self, words: list[str], least_probability: float,
                 least_overlap: float) -> tuple[list[tuple[str, float, float]], bool]:
        """The confirmed families, and whether there was a prediction that nothing confirms."""
        if self.single.isdisjoint(words):
            return [], False
        found = self.found(words)
        shares = self.shares(found, len(words) <= SHORT)
        said = self._predict(found, shares)
        if said is not None and said[1] < least_probability:
            said = None
        out = [said] if said and self.confirms(said, words, least_overlap) else []
        for family, share, own in shares:
            if share < least_overlap or any(family == f for f, _, _ in out):
                continue
            # The template's stretch is judged by itself, without its neighbours.
            stretch = self._stretch(words, own)
            local = self.judge(stretch)
            if local and local[0] == family and local[1] >= least_probability \
                    and self.confirms(local, stretch, least_overlap):
                out.append(local)
        return out, said is not None and not out

    @staticmethod
    def _stretch(words: list[str], own: set) -> list[str]:
        """The words that hold most of a template's shingles within little more than its length."""
        size = len(next(iter(own)))
        hits = [(i, g) for i in range(len(words) - size + 1) if (g := tuple(words[i:i + size])) in own]
        reach = len(own) + len(own) // 4 + 2
        near = max(([h for h in hits[k:] if h[0] < i + reach] for k, (i, _) in enumerate(hits)),
                   key=lambda hs: len({g for _, g in hs}))
        # With the words that stand where the template's missing ones would: they may tell it apart.
        missing = len(own) - len({g for _, g in near})
        return words[max(0, near[0][0] - missing):near[-1][0] + size + missing]

    def paragraph(self, words: list[str], least_probability: float,
                  least_overlap: float) -> tuple[list[tuple[str, float, float]], int]:
        """What the windows of a paragraph confirm, and how many confirm no prediction."""
        out, doubtful = [], 0
        for window in windows(words):
            confirmed, doubt = self.verdicts(window, least_probability, least_overlap)
            out += confirmed
            doubtful += doubt
        # "Either version 3 of the License" speaks of the licence that the paragraph names.
        if any(said[0] in OTHER_GNU for said in out) and not any(
                tuple(words[i:i + 3]) == GNU_NAME for i in range(len(words) - 2)):
            out = [said for said in out if said[0] not in GNU]
        return out, doubtful


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample_docs: int = 200, sample_paragraphs: int = 1500) -> Classifier:
    """A classifier with the paragraphs of a bounded sample as background."""
    drawn = (docs.select(F.col(id_col).alias("i"))
             .orderBy(F.xxhash64("i", F.lit("licenses")), "i").limit(sample_docs).collect())
    ids = sorted({r[0] for r in drawn if r[0] is not None})
    # Ids can repeat: the number of rows is bounded too. Of a sampled text its first 20,000
    # characters are background.
    rows = docs.filter(F.col(id_col).isin(ids)).select(
        F.col(id_col), F.substring(text_col, 1, 20_000).alias("text")).orderBy(
        F.xxhash64(id_col, "text"), id_col, "text").limit(4 * sample_docs).collect() \
        if ids else []
    found = sorted({" ".join(w) for r in rows for p in paragraphs(r[1])
                    for w in windows(tokens(p)) if w})
    rand = random.Random(5)
    rand.shuffle(found)
    return Classifier(found[:sample_paragraphs])


def scan(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id",
         text_col: str = "text", least_probability: float = 0.5,
         least_overlap: float = 0.7) -> DataFrame:
    """One row per document: its confirmed licences and the best prediction."""
    sent = docs.sparkSession.sparkContext.broadcast(classifier)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def one(text: str | None) -> tuple:
        model = sent.value
        n, hits, doubtful, best = 0, {}, 0, None
        for paragraph in paragraphs(text):
            n += 1
            confirmed, doubt = model.paragraph(tokens(paragraph), least_probability,
                                               least_overlap)
            doubtful += doubt
            for said in confirmed:
                hits[said[0]] = hits.get(said[0], 0) + 1
                if best is None or (said[2], said[1]) > (best[2], best[1]):
                    best = said
        return n, sum(hits.values()), doubtful, ",".join(sorted(hits)) or None, \
            best and best[0], best and round(best[1], 6), best and round(best[2], 6)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = list(zip(*map(one, batch.column("text").to_pylist()))) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
                     pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds))],
                names=["doc_id", "n_paragraphs", "n_confirmed", "n_unconfirmed", "licenses",
                       "license", "probability", "overlap"])

    return rows.mapInArrow(
        judge, f"doc_id {kind}, n_paragraphs long, n_confirmed long, n_unconfirmed long, "
        "licenses string, license string, probability double, overlap double")
