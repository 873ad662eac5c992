from __future__ import annotations

import hashlib
import random
import time
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm.queries import looped, op13_periodic_runs
from tallybook.llm.runs import Grammar, collapsed, find_runs, periodic_runs, stretches
from tests.llm.conftest import counted


def plain(w: list[str]) -> list[tuple[int, int, int]]:
    """Every period at every place."""
    n, found = len(w), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            if j > i and e - s >= max(6, 4 * q):
                if not any(all(w[k] == w[k + p] for k in range(s, e - p)) for p in range(1, q)):
                    found.add((s, e, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def some_words(draw: random.Random, longest: int) -> list[str]:
    n, letters = draw.randint(0, longest), "abcdefgh"[: draw.choice([1, 2, 2, 3, 4, 8])]
    w = [draw.choice(letters) for _ in range(n)]
    for _ in range(draw.randint(0, 2)):
        if n:
            a = draw.randrange(n)
            p, stop = 1 + (n - a) // draw.randint(3, 10), draw.randint(a, n)
            w = [w[a + (i - a) % p] if a <= i < stop else w[i] for i in range(n)]
    return w


@pytest.mark.parametrize("seed", range(4))
def test_same_as_every_period_at_every_place(seed):
    draw = random.Random(seed)
    for _ in range(500):
        w = some_words(draw, 80)
        assert periodic_runs(w) == plain(w), w


@pytest.mark.parametrize("text", ["", "a", "a a a a a", "a a a a a a", "a b a b a b a", "a b a b a b a b", "x a a a a a a a y"])
def test_shortest_runs(text):
    w = text.split()
    assert periodic_runs(w) == plain(w)


def test_words_of_fibonacci_and_of_powers():
    a, b = "a", "ab"
    while len(b) < 700:
        a, b = b, b + a
    for w in (list(b), list("ab" * 300), list("a" * 500), list("aab" * 90 + "ab" * 50), list(("a" * 9 + "b") * 20)):
        assert periodic_runs(w) == plain(w)


def test_grammar_derives_its_text():
    draw = random.Random(9)
    for _ in range(200):
        w = some_words(draw, 120)
        numbers = np.array([ord(c) for c in w], np.int64)
        cuts = stretches(numbers)
        grammar = Grammar(numbers, cuts)
        for places, left, right in grammar.nodes:
            assert len({tuple(w[p : p + left + right]) for p in places}) == 1
        tops = [p for x in grammar.tops for p in x]
        assert len(tops) == sum(b - a for a, b in cuts) - sum(len(places) for places, _, _ in grammar.nodes)


def test_nothing_repeats_in_what_is_left():
    numbers = np.array([1, 2, 3, 4, 5] * 40)
    grammar = Grammar(numbers, [(0, 200)])
    assert len(grammar.tops[0]) < 12


@pytest.mark.parametrize(
    "make",
    [
        lambda n: ["a"] * n,
        lambda n: [str(k % 5000) for k in range(n)],
        lambda n: [random.Random(k).choice("ab") for k in range(n)],
        lambda n: ["a" if k % 40 else "b" for k in range(n)],
    ],
)
def test_time_grows_with_the_text(make):
    def seconds(n: int) -> float:
        words, started = make(n), time.perf_counter()
        periodic_runs(words)
        return time.perf_counter() - started

    seconds(1000)
    assert seconds(80_000) < 6 * seconds(20_000) + 1


def test_one_period_stays():
    w = "x a b a b a b a b y".split()
    assert collapsed(w, periodic_runs(w)) == "x a b y"
    w = "a a a a a a b a a a a a a b a a a a a a b a a a a a a b".split()
    runs = periodic_runs(w)
    gone = {k for s, e, q in runs for k in range(s + q, e)}
    assert collapsed(w, runs) == " ".join(x for k, x in enumerate(w) if k not in gone)


def test_odd_documents(spark, edge_documents, no_documents):
    rows = find_runs(edge_documents)
    assert rows.columns == ["doc_id", "n_words", "runs", "collapsed"]
    texts = [(r["doc_id"], r["text"]) for r in edge_documents.select("doc_id", "text").collect()]
    found = counted((r["doc_id"], r["n_words"], r["collapsed"], str(r["runs"])) for r in rows.collect())
    expected = []
    for doc_id, text in texts:
        import re

        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = periodic_runs(w)
        listed = rows.sparkSession.createDataFrame([([(a, b - a, q) for a, b, q in runs],)], rows.select("runs").schema).first()[0]
        expected.append((doc_id, len(w), collapsed(w, runs), str(listed)))
    assert found == counted(expected)
    assert find_runs(no_documents).count() == 0


def test_query_against_plain_reading(spark, small):
    """Each row of the query, computed by definition, for texts short enough for it."""
    import re

    got = {r["doc_id"]: r for r in op13_periodic_runs(spark, small).collect()}
    texts = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    looping = 0
    for doc_id, text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = crc32(str(doc_id).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            looping += 1
        if len(w) > 1500:
            continue
        runs = plain(w)
        row = got[doc_id]
        lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
        gone = {k for s, e, q in runs for k in range(s + q, e)}
        best = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
        expected = (None,) * 4 if best is None else (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
        assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == expected
        assert row["n_runs"] == len(runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert row["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert looping > 5


def test_looped_documents():
    assert looped(None, ["a"]) == ["a"]
    doc_id = next(k for k in range(1000) if crc32(str(k).encode()) % 10 == 0)
    assert looped(doc_id, []) == []
    words = [str(k) for k in range(300)]
    assert looped(doc_id, words) != words and len(looped(doc_id, words)) == 300


def test_query_types(spark, small):
    kinds = dict(op13_periodic_runs(spark, small).dtypes)
    assert all(kinds[c] == "bigint" for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli"))
    assert op13_periodic_runs(spark, small).where(F.col("runs_sha256").isNull() | F.col("collapsed_sha256").isNull()).isEmpty()
