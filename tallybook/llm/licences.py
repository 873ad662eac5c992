"""Licence scans: a trained classifier of paragraphs, confirmed against templates.

Paragraphs (lines with a word) are classified by a sparse multinomial logistic
regression over hashed word n-grams.  It is trained on variants of the licence
notices below (words lost, words of the corpus around them) and, as the class
``unknown``, on a bounded sample of the corpus's own paragraphs, on notices of no
family and on sentences that speak of a licence without being a notice.  Its
chances are calibrated by a temperature fitted to notices it has not seen.  A
paragraph is a licence if all families together have a chance of ``MIN_CHANCE``.
It is reported for each family that has ``MIN_FAMILY`` itself and a template
that agrees: it shares ``SIMILARITY`` of the shingles of the shorter of the two,
or that share of the template's words stands in order close together.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.hashing import WORD, WordHashes, grams

UNKNOWN = "unknown"
SAMPLE = 3_000  # about so many documents give a paragraph to train on, chosen by a hash of the row
VARIANTS, SHORT_VARIANTS = 30, 4  # of each notice
HELD_BACK = 5  # one notice in so many sets the temperature
SPARE_WORDS = 4
BITS, UP_TO, EPOCHS = 18, 3, 4
ALPHA, BETA, L1, L2 = 0.2, 1.0, 0.3, 0.01
SHINGLE_WORDS = 5
SIMILARITY = 0.8
MIN_CHANCE = 0.5
MIN_FAMILY = 0.2  # two families of one notice share its chance
TEMPERATURES = (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)
SCHEMA = "doc_id bigint, licences string, n_paragraphs bigint, n_licence_paragraphs bigint, n_unconfirmed bigint, chance double"

# Notices as their licences word them (fixed values).
NOTICES: dict[str, tuple[str, ...]] = {
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Released under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC0": (
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
}
# What notices call a licence, the shortest first (fixed values).
NAMES: dict[str, tuple[str, ...]] = {
    "Apache": ("Apache 2.0", "Apache License", "Apache License 2.0"),
    "MIT": ("MIT", "MIT License"),
    "BSD": ("BSD", "BSD License", "BSD 3-Clause License"),
    "GPL": ("GPL", "GPLv2", "GPLv3", "GNU General Public License"),
    "LGPL": ("LGPL", "LGPLv3", "GNU Lesser General Public License"),
    "AGPL": ("AGPL", "AGPLv3", "GNU Affero General Public License"),
    "MPL": ("MPL 2.0", "Mozilla Public License"),
    "ISC": ("ISC", "ISC License"),
    "CC-BY": ("CC BY 4.0", "Creative Commons Attribution 4.0"),
    "CC-BY-SA": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"),
    "CC-BY-NC": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"),
    "CC0": ("CC0", "CC0 1.0 Universal"),
    "Unlicense": ("Unlicense", "The Unlicense"),
}
# Short notices of one licence and of two, and sentences about a licence that are no notice (fixed values).
NOTICE_OF_ONE = (
    "License: {}",
    "Licensed under {}",
    "Licensed under the {}",
    "Released under the {}",
    "SPDX-License-Identifier: {}",
)
NOTICE_OF_TWO = (
    "Dual licensed under the {} and the {}.",
    "Licensed under either the {} or the {}, at your option.",
    "SPDX-License-Identifier: {} OR {}",
)
NO_NOTICE = (
    "She failed the {} exam twice.",
    "The {} exam takes an hour.",
    "I passed my driving test before the {} was written.",
    "My {} expired in May.",
    "I lost my {} on the way.",
    "We talked about the {} at dinner.",
    "He wrote an article about the {}.",
    "A lecture on the {} is given at noon.",
    "The history of the {} is long.",
    "Why did they choose the {}?",
    "Unlike the {}, it asks for more.",
    "They moved away from the {} last year.",
    "This is not licensed under the {}.",
    "It was never released under the {}.",
    "It is available, but never under the {}.",
    "Not under the {}, as some believe.",
    "It is no longer licensed under the {}.",
    "Nothing here is released under the {}.",
    "Under {} but not under the {}.",
    "It is neither under the {} nor under the {}.",
    "You may use it under the {}, but never under the {}.",
)
NO_FAMILY = (
    "All rights reserved.",
    "Licensed under the terms agreed with the vendor.",
    "Released under a proprietary license, see the contract.",
    "You need a driving license to rent a car.",
    "The license was granted by the city last year.",
    "No part of this publication may be reproduced without the written permission of the publisher.",
)
CLASSES = (UNKNOWN, *NOTICES)


@dataclass(frozen=True)
class Classifier:
    index: np.ndarray  # of the grams with a weight
    weight: np.ndarray  # by gram and class
    bias: np.ndarray
    temperature: float

    def dense(self) -> np.ndarray:
        weights = np.zeros((1 << BITS, len(CLASSES)), np.float32)
        weights[self.index] = self.weight
        return weights


def _features(text: str, hashes: WordHashes) -> np.ndarray:
    return np.unique(grams(hashes.of(text), UP_TO, 0, BITS))


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _short_notices() -> list[tuple[str, tuple[int, ...]]]:
    """Short notices and sentences that are none, with the classes they belong to."""
    rows = []
    for k, (_, names) in enumerate(NAMES.items(), 1):
        rows += [(frame.format(x), (k,)) for x in names for frame in NOTICE_OF_ONE]
        rows += [(x, (k,)) for x in names if " " in x]
        rows += [(frame.format(x, x), (0,)) for x in names for frame in NO_NOTICE if frame.count("{}") == 1]
        for other, (_, others) in enumerate(NAMES.items(), 1):
            if other != k:
                for a, b in product(dict.fromkeys((names[0], names[-1])), dict.fromkeys((others[0], others[-1]))):
                    rows += [(frame.format(a, b), (k, other)) for frame in NOTICE_OF_TWO]
                    rows += [(frame.format(a, b), (0,)) for frame in NO_NOTICE if frame.count("{}") == 2]
    return rows


def _examples(corpus: list[str]) -> list[tuple[str, int, int]]:
    """Paragraphs, their classes and the notice each is a variant of; the order in which the corpus came does not matter."""
    corpus = sorted(corpus)
    draw = random.Random(0)
    words = [w for x in corpus[:200] for w in x.split()[:20]] or ["text"]
    notices = [(x, (0,), VARIANTS, 0.08) for x in NO_FAMILY]
    notices += [(x, (k,), VARIANTS, 0.08) for k, some in enumerate(NOTICES.values(), 1) for x in some]
    # A short notice that lost a word may be another's, or none.
    notices += [(x, classes, SHORT_VARIANTS // (2 * len(classes)), 0.0) for x, classes in _short_notices()]
    rows = []
    for origin, (notice, classes, variants, loss) in enumerate(notices):
        for k in classes:
            rows.append((notice, k, origin))
            for _ in range(variants):
                kept = [w for w in notice.split() if draw.random() >= loss]
                ahead, behind = ([draw.choice(words) for _ in range(draw.choice((0, 0, 4, 12)))] for _ in range(2))
                rows.append((" ".join(ahead + kept + behind), k, origin))
    rows += [(x, 0, len(notices) + n) for n, x in enumerate(corpus) if _likeness(x, _ALL_SHINGLES) < 0.3]
    draw.shuffle(rows)
    return rows


def _weights(rows: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Grams and their weights by class, the bias last: FTRL-proximal, as sparse as ``L1`` makes it."""
    index = np.unique(np.concatenate([x for x, _ in rows]))
    last = len(index)
    z, n = np.zeros((last + 1, len(CLASSES))), np.zeros((last + 1, len(CLASSES)))

    def weights(at) -> np.ndarray:
        step = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, step)

    located = [(np.append(np.searchsorted(index, x), last), k) for x, k in rows]
    for _ in range(EPOCHS):
        for at, k in located:
            w = weights(at)
            error = _softmax(w.sum(axis=0))
            error[k] -= 1
            z[at] += error - (np.sqrt(n[at] + error**2) - np.sqrt(n[at])) / ALPHA * w
            n[at] += error**2
    return index, weights(slice(None))


def _scores(index: np.ndarray, weights: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    return np.array([np.concatenate([weights[:-1][np.isin(index, x)], weights[-1:]]).sum(axis=0) for x in rows])


def fit(corpus: list[str], held_back: int = HELD_BACK) -> Classifier:
    """Train on the notices and on paragraphs of the corpus (at most some thousands).

    The temperature is found with one in ``held_back`` notices left out with all
    its variants, so on notices the weights do not know; then all are trained on.
    """
    hashes = WordHashes()
    rows = [(_features(x, hashes), k, origin) for x, k, origin in _examples(corpus)]
    unseen = [(x, k) for x, k, origin in rows if origin % held_back == 0]
    scores = _scores(*_weights([(x, k) for x, k, origin in rows if origin % held_back]), [x for x, _ in unseen])
    truth = np.array([k for _, k in unseen])
    loss = {t: -np.log(_softmax(scores / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in TEMPERATURES}
    index, full = _weights([(x, k) for x, k, _ in rows])
    used = np.flatnonzero(np.abs(full[:-1]).sum(axis=1))
    return Classifier(index[used], full[used].astype(np.float32), full[-1], min(TEMPERATURES, key=loss.get))


def _shingles(text: str) -> set[tuple[str, ...]]:
    words = WORD.findall(text.lower())
    if len(words) < SHINGLE_WORDS:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + SHINGLE_WORDS]) for k in range(len(words) - SHINGLE_WORDS + 1)}


TEMPLATES = {family: [_shingles(x) for x in notices] for family, notices in NOTICES.items()}
_ALL_SHINGLES = [x for family in TEMPLATES.values() for x in family]


def _likeness(paragraph: str, templates: list[set]) -> float:
    """The most that a template and the paragraph share, of the shorter one's shingles."""
    own = _shingles(paragraph)
    return max((len(own & x) / min(len(own), len(x)) for x in templates), default=0.0) if own else 0.0


def _words(text: str) -> list[str]:
    return WORD.findall(text.lower())


# The words of each family's notices, long and short, to be found in their order.
WORDINGS: dict[str, list[list[str]]] = {family: [_words(x) for x in notices] for family, notices in NOTICES.items()}
for _text, _classes in _short_notices():
    if len(_classes) == 1 and _classes[0]:
        WORDINGS[CLASSES[_classes[0]]].append(_words(_text))


def _in_order(words: list[str], wording: list[str]) -> bool:
    """Whether ``SIMILARITY`` of a wording's words stand in their order in some stretch of about twice its length.

    The longest common subsequence, a bit for each word of the wording.
    """
    size = len(wording)
    bits: dict[str, int] = {}
    for k, w in enumerate(wording):
        bits[w] = bits.get(w, 0) | 1 << k
    whole = (1 << size) - 1
    for start in range(0, max(1, len(words) - size - SPARE_WORDS), size):
        free = whole
        for w in words[start : start + 2 * size + SPARE_WORDS]:
            if found := bits.get(w):
                here = free & found
                free = ((free + here) | (free - here)) & whole
        if size - free.bit_count() >= SIMILARITY * size:
            return True
    return False


def _agrees(paragraph: str, family: str) -> bool:
    """Whether a template of the family says the same: by its shingles, or by its words in order."""
    if _likeness(paragraph, TEMPLATES[family]) >= SIMILARITY:
        return True
    words = _words(paragraph)
    known = set(words)
    return any(
        sum(w in known for w in wording) >= SIMILARITY * len(wording) and _in_order(words, wording)
        for wording in WORDINGS[family]
    )


def train(documents: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Fit with a paragraph each of about ``sample`` documents, in one task."""
    rows = documents.where("text is not null")
    share = min(1.0, sample / max(1, documents.count()))
    rows = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < int(share * 1_000_000))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"\w"))
    one = F.get("lines", F.pmod(F.xxhash64("doc_id", "lines"), F.greatest(F.size("lines"), F.lit(1))).cast("int"))
    rows = rows.select("doc_id", lines.alias("lines")).select(one.alias("line")).where("line is not null")

    def fitted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = fit([x for batch in batches for x in batch.column(0).to_pylist()])
        index = np.append(found.index, [-1, -2])
        weight = [*found.weight.astype(float).tolist(), found.bias.tolist(), [found.temperature]]
        yield pa.RecordBatch.from_arrays([pa.array(index), pa.array(weight, pa.list_(pa.float64()))], ["index", "weight"])

    model = rows.repartition(1).mapInArrow(fitted, "index bigint, weight array<double>").toPandas()
    if model.empty:
        return fit([])
    special = dict(zip(model["index"].iloc[-2:], model["weight"].iloc[-2:]))
    grams_ = model.iloc[:-2]
    weight = np.array(grams_["weight"].tolist(), np.float32).reshape(-1, len(CLASSES))
    return Classifier(grams_["index"].to_numpy(np.int64), weight, np.array(special[-1]), float(special[-2][0]))


def scan(documents: DataFrame, classifier: Classifier) -> DataFrame:
    """One row a document: doc_id, licences (sorted, joined by commas; empty if none), counts, chance.

    ``n_unconfirmed`` counts paragraphs classified as a licence that no
    template confirms; ``chance`` is the best confirmed one's (NULL if none).
    NULL and empty texts have no paragraph; other columns are ignored.
    """

    def scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, hashes = classifier.dense(), WordHashes()
        telling = np.zeros(1 << BITS, bool)
        telling[classifier.index] = True
        for batch in batches:
            rows = [_scanned(x or "", classifier, weights, telling, hashes) for x in batch.column(1).to_pylist()]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            columns = list(zip(*rows)) or [[] for _ in kinds]
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in SCHEMA.split(", ")])

    return documents.select("doc_id", "text").mapInArrow(scanned, SCHEMA)


def _scanned(text: str, classifier: Classifier, weights, telling, hashes) -> tuple:
    families, paragraphs, confirmed, doubtful, best = set(), 0, 0, 0, None
    for line in text.split("\n"):
        words = hashes.of(line)
        if not len(words):
            continue
        paragraphs += 1
        found = grams(words, UP_TO, 0, BITS)
        found = np.unique(found[telling[found]])
        chances = _softmax((weights[found].sum(axis=0) + classifier.bias) / classifier.temperature)
        if chances[0] > 1 - MIN_CHANCE:
            continue
        likely = [f for f, chance in zip(CLASSES[1:], chances[1:]) if chance >= MIN_FAMILY]
        here = {family for family in likely if _agrees(line, family)}
        if here:
            families |= here
            confirmed += 1
            best = max(best or 0.0, *(float(chances[CLASSES.index(x)]) for x in here))
        else:
            doubtful += 1
    return ",".join(sorted(families)), paragraphs, confirmed, doubtful, best
