from __future__ import annotations

import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybook.llm import decision_list as dl
from tallybook.llm.queries import QUERIES

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def plain(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(zip(words, words[1:], words[2:]))
    repeated = {k + j for k in range(len(words) - 2) if seen[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def counts(documents):
    return documents.select("doc_id", dl.statistics().alias("s")).select("doc_id", *(f"s.{n}" for n in NAMES))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n#|<é\x0b ", max_size=60), min_size=20, max_size=60))
def test_statistics(spark, texts):
    rows = counts(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {k: plain(x) for k, x in enumerate(texts)}


def test_edge_cases(spark, edge_documents, no_documents):
    rows = counts(edge_documents).collect()
    texts = [r.text for r in edge_documents.collect()]
    assert sorted(tuple(r)[1:] for r in rows) == sorted(map(plain, texts))
    labels = spark.createDataFrame([(1, 0), (None, 0), (3, None), (9, 1)], "doc_id bigint, quality int")
    rules = dl.learn(edge_documents, labels)
    assert rules.rules == () and dl.learn(no_documents, labels.limit(0)).rules == ()
    kept = dl.kept_documents(edge_documents, rules)
    assert kept.columns == edge_documents.columns
    assert {r.doc_id for r in kept.collect()} == {3}  # the others are short
    assert dl.judged(no_documents, rules).count() == 0


def test_learns_conjunctions(spark):
    """Bad: many symbols and long words; either alone is good."""
    draw = random.Random(0)
    rows, labels = [], []
    for k in range(1200):
        symbols, long_words = draw.random() < 0.5, draw.random() < 0.5
        word = "abcdefghijklmn" if long_words else "abc"
        ends = ["#" if symbols and draw.random() < 0.5 else "e" for _ in range(80)]
        text = " ".join(f"{word}{draw.randrange(10**5):05}{end}" for end in ends)
        rows.append((k, text))
        labels.append((k, int(not (symbols and long_words))))
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    rules = dl.learn(documents, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    verdict = {r.doc_id: r.kept for r in dl.judged(documents, rules).collect()}
    assert sum(verdict[k] == bool(q) for k, q in labels) >= 1180
    assert {c.feature for rule in rules.rules for c in rule} == {"mean_word", "symbol_share"}


def test_query(spark, medium):
    rows = QUERIES["op4_decision_list"](spark, medium)
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    found = rows.collect()
    assert len(found) == len(texts)
    for r in found:
        n, chars, symbols, lines, repeated = plain(texts[r.doc_id])
        assert tuple(r)[1:6] == (n, chars, symbols, lines, repeated)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (r.base_failed and r.kept)
    judged = rows.where("not base_failed").join(labels, "doc_id").where(F.col("kept") != (F.col("quality") == 1)).count()
    assert judged <= 0.02 * labels.count()
    assert not re.search("Python|Arrow", rows._jdf.queryExecution().toString())
