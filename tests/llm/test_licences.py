from __future__ import annotations

import math
import random
from itertools import product

import pytest

from tallybook.llm import licences
from tallybook.llm.queries import QUERIES


@pytest.fixture(scope="module")
def classifier(spark, medium):
    return licences.train(spark.read.parquet(f"{medium}/documents.parquet"))


def scanned(spark, classifier, texts):
    rows = licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), classifier).collect()
    return [r for _, r in sorted((r.doc_id, r) for r in rows)]


def test_notices_are_found_in_texts(spark, classifier):
    notices = [(family, x) for family, some in licences.NOTICES.items() for x in some if not x.startswith("SPDX")]
    texts = [f"Some words ahead of it.\n{x}\nSome words behind it." for _, x in notices]
    found = scanned(spark, classifier, texts)
    assert sum(r.licences == family for r, (family, _) in zip(found, notices)) >= 0.95 * len(notices)
    assert all(r.n_paragraphs == 3 for r in found)


def test_neighbours_are_told_apart(spark, classifier):
    texts = [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under CC BY-SA 4.0.",
        "Licensed under CC BY-NC 4.0.",
    ]
    assert [r.licences for r in scanned(spark, classifier, texts)] == ["LGPL", "AGPL", "GPL", "CC-BY-SA", "CC-BY-NC"]


def test_other_paragraphs_are_not_reported(spark, classifier):
    texts = ["All rights reserved.", "He lost his driving license under the bridge.", "Released under a new name.", "the public domain of the city"]
    assert [r.licences for r in scanned(spark, classifier, texts)] == [""] * 4


SHORT = {
    "SPDX-License-Identifier: MIT": "MIT",
    "SPDX-License-Identifier: ISC": "ISC",
    "main.c SPDX-License-Identifier: MIT": "MIT",
    "SPDX-License-Identifier: MIT OR Apache-2.0": "Apache,MIT",
    "SPDX-License-Identifier: GPL-2.0-only": "GPL",
    "MIT License": "MIT",
    "The MIT License (MIT)": "MIT",
    "License: GPL": "GPL",
    "Licensed under Apache License 2.0": "Apache",
    "GNU General Public License v3.0": "GPL",
    "GNU Lesser General Public License v3.0": "LGPL",
    "Dual licensed under the MIT license and the GPL.": "GPL,MIT",
    "License: CC BY-SA 4.0": "CC-BY-SA",
}


def test_short_and_dual_notices(spark, classifier):
    found = scanned(spark, classifier, [f"Some words ahead of it.\n{x}\nSome words behind it." for x in SHORT])
    assert dict(zip(SHORT, (r.licences for r in found))) == SHORT
    assert all(r.n_licence_paragraphs == 1 and r.chance for r in found)


SPEECH = (
    "I passed my MIT license exam to drive",
    "under GPL but never under the MIT License",
    "The committee discussed the Apache License for an hour.",
    "This is not released under the GNU General Public License.",
)


def test_sentences_about_a_licence_are_no_notice(spark, classifier):
    assert [r.licences for r in scanned(spark, classifier, SPEECH)] == [""] * len(SPEECH)


def test_new_lossy_variants_of_notices_are_recalled(spark, classifier):
    """Words lost at random, other than in any variant trained on."""
    draw = random.Random(7)
    rows = [(f, x) for f, some in licences.NOTICES.items() for x in some if len(x.split()) >= 8 for _ in range(10)]
    texts = [" ".join(w for w in x.split() if draw.random() >= 0.08) for _, x in rows]
    found = scanned(spark, classifier, texts)
    assert sum(f in r.licences.split(",") for (f, _), r in zip(rows, found)) >= 0.9 * len(rows)


def common_words(a, b):
    """Length of the longest common subsequence, by the textbook's table."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in product(range(len(a)), range(len(b))):
        table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_words_in_order_against_a_table():
    draw = random.Random(3)
    for _ in range(400):
        words = draw.choices("abcd", k=draw.randrange(0, 30))
        wording = draw.choices("abcd", k=draw.randrange(1, 9))
        reach = 2 * len(wording) + licences.SPARE_WORDS
        starts = range(0, max(1, len(words) - len(wording) - licences.SPARE_WORDS), len(wording))
        best = max(common_words(words[k : k + reach], wording) for k in starts)
        assert licences._in_order(words, wording) == (best >= licences.SIMILARITY * len(wording))
    # Nothing that stands within the wording's length and the spare words is missed, wherever it is.
    for ahead in range(40):
        assert licences._in_order(["x"] * ahead + ["a", "y", "b", "y", "c"] + ["x"] * (ahead % 7), ["a", "b", "c"])


def plainly_scanned(text, classifier):
    """The same answer for one text, gram by gram."""
    known = {int(g): w for g, w in zip(classifier.index, classifier.weight)}
    families, paragraphs, confirmed, doubtful = set(), 0, 0, 0
    for line in text.split("\n"):
        if not licences.WORD.search(line):
            continue
        paragraphs += 1
        scores = classifier.bias.astype(float).copy()
        for g in {int(g) for g in licences.grams(licences.WordHashes().of(line), licences.UP_TO, 0, licences.BITS)}:
            scores += known.get(g, 0)
        chances = [math.exp(x / classifier.temperature) for x in scores]
        chances = [x / sum(chances) for x in chances]
        if chances[0] > 1 - licences.MIN_CHANCE:
            continue
        words, here = licences._words(line), set()
        for family, chance in zip(licences.CLASSES[1:], chances[1:]):
            for wording in licences.WORDINGS[family]:
                reach = 2 * len(wording) + licences.SPARE_WORDS
                starts = range(0, max(1, len(words) - len(wording) - licences.SPARE_WORDS), len(wording))
                same = any(common_words(words[k : k + reach], wording) >= 0.8 * len(wording) for k in starts)
                if chance >= licences.MIN_FAMILY and same:
                    here.add(family)
            if chance >= licences.MIN_FAMILY and licences._likeness(line, licences.TEMPLATES[family]) >= 0.8:
                here.add(family)
        families |= here
        confirmed, doubtful = confirmed + bool(here), doubtful + (not here)
    return ",".join(sorted(families)), paragraphs, confirmed, doubtful


def test_scan_against_a_plain_version(spark, classifier, medium):
    documents = spark.read.parquet(f"{medium}/documents.parquet").where("text rlike '(?i)licen[sc]e'").limit(60)
    texts = [*SHORT, *SPEECH, "", "\n\n", "one\nLicense: GPL\n\nMIT License", *(r.text for r in documents.collect())]
    found = scanned(spark, classifier, texts)
    got = [(r.licences, r.n_paragraphs, r.n_licence_paragraphs, r.n_unconfirmed) for r in found]
    assert got == [plainly_scanned(x, classifier) for x in texts]


def test_query(spark, medium):
    rows = QUERIES["op5_licences"](spark, medium).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    lines = {
        "Licensed under the Apache License, Version 2.0.": "Apache",
        "Released under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    }
    planted = {k: ",".join(sorted({f for x, f in lines.items() if x in t.split("\n")})) for k, t in texts.items()}
    assert {r.doc_id: r.licences for r in rows} == planted
    assert all((r.chance is None) == (r.licences == "") for r in rows)


def test_edge_cases(spark, edge_documents, no_documents, classifier):
    rows = licences.scan(edge_documents, classifier).collect()
    assert len(rows) == edge_documents.count() and {r.licences for r in rows} == {""}
    assert licences.scan(no_documents, classifier).count() == 0
    untaught = licences.train(no_documents)
    assert scanned(spark, untaught, ["Licensed under the MIT License."])[0].licences == "MIT"
