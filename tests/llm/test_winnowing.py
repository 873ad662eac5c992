from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tallybook.llm import winnowing
from tallybook.llm.winnowing import contamination, decontaminated


def words(text: str | None) -> list[str]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(text: str | None, items: list[tuple[int, str | None]]) -> tuple[int, int, list[int]]:
    own, hit, found = words(text), set(), set()
    for item, passage in items:
        w = words(passage)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            for i in range(len(own) - n + 1):
                if own[i : i + n] == w[k : k + n]:
                    hit.update(range(i, i + n))
                    found.add(item)
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_of_few_words(spark, seed):
    """Few distinct words make many repeated and overlapping windows."""
    draw = random.Random(seed)
    alphabet = ["a", "B", "c", "É", "d1"]
    text = lambda n: " ".join(draw.choice(alphabet) for _ in range(n))
    items = [(k, text(draw.choice([0, 1, 3, 7, 9, 10, 11, 25]))) for k in range(12)] + [(12, None), (13, "zz")]
    # Single common words would make every document a hit.
    items = [(k, x) for k, x in items if len(words(x)) != 1 or x == "zz"]
    documents = [(k, text(draw.choice([0, 2, 9, 10, 60, 400]))) for k in range(40)] + [(40, None), (41, "x zz y")]
    rows = contamination(spark.createDataFrame(documents, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    found = {r.doc_id: (r.n_words, r.n_hit, sorted(r["items"])) for r in rows.collect()}
    assert found == {k: plain(x, items) for k, x in documents}


@pytest.mark.parametrize("window", range(1, 13))
def test_any_shared_span_of_a_window_is_found(spark, window):
    draw = random.Random(window)
    body = [f"w{draw.randrange(10**6)}" for _ in range(60)]
    items = spark.createDataFrame([(1, " ".join(body))], "item_id bigint, text string")
    cuts = [(k, "x1 " + " ".join(body[k : k + window]) + " y1") for k in range(60 - window + 1)]
    rows = winnowing.hits(spark.createDataFrame(cuts, "doc_id bigint, text string"), items, window)
    assert {(r.doc_id, r["first"]) for r in rows.collect()} == {(k, 1) for k, _ in cuts}


def test_edge_cases(spark, edge_documents, no_documents):
    items = spark.createDataFrame([(1, "QUICK brown fox jumps"), (None, "wise owls"), (2, ""), (3, None)], "item_id bigint, text string")
    rows = contamination(edge_documents, items).collect()
    assert len(rows) == edge_documents.count()
    assert sorted(r.n_hit for r in rows) == [0] * 7 + [6, 6]  # a window of an item without id counts
    assert {tuple(r["items"]) for r in rows} == {(), (1,)}
    assert contamination(no_documents, items).count() == 0
    assert contamination(edge_documents, items.limit(0)).where("n_hit > 0").count() == 0
    kept = decontaminated(edge_documents, items, least=2)
    assert kept.columns == edge_documents.columns and kept.count() == 7


def test_short_items_condemn_no_document(spark):
    words = [f"w{k}" for k in range(30)]
    documents = spark.createDataFrame([(0, " ".join(words)), (1, "yes"), (2, " ".join(words[:9])), (3, " ".join(words[3:13])), (4, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "yes"), (2, "w1 w2"), (3, " ".join(words[20:27]))], "item_id bigint, text string")
    assert contamination(documents, items).where("n_hit > 0").count() == 3
    assert decontaminated(documents, items).count() == 5
    longer = items.unionByName(spark.createDataFrame([(4, " ".join(words[1:9])), (5, " ".join(words[:25]))], "item_id bigint, text string"))
    assert {r.doc_id for r in decontaminated(documents, longer).collect()} == {1, 4}


def test_native(spark, edge_documents):
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    plan = contamination(edge_documents, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Cartesian|NestedLoop", plan)


def test_items_share_a_window(spark):
    passage = " ".join(f"w{k}" for k in range(12))
    items = spark.createDataFrame([(k, passage) for k in range(30)], "item_id bigint, text string")
    documents = spark.range(50).select(F.col("id").alias("doc_id"), F.lit(f"x {passage} y").alias("text"))
    rows = contamination(documents, items).collect()
    assert {(r.n_words, r.n_hit, len(r["items"])) for r in rows} == {(14, 12, 30)}


def test_lists_of_items_do_not_travel_with_documents(spark):
    """Each window is held by very many items; what is told of a list is computed once per distinct list."""
    passage = [f"w{k}" for k in range(14)]
    texts = [" ".join(passage[:11]), " ".join(passage[4:]), " ".join(passage)]
    items = spark.createDataFrame([(k, texts[k % 3]) for k in range(3000)], "item_id bigint, text string")
    documents = spark.createDataFrame([(k, [f"x {texts[0]} y", texts[1], "no", "", None][k % 5]) for k in range(60)], "doc_id bigint, text string")
    told = {"n": "size(items)", "largest": "array_max(items)", "first": "get(items, 0)"}
    rows = contamination(documents, items, told=told)
    listed = {r.doc_id: sorted(r["items"]) for r in contamination(documents, items).collect()}
    by_kind = [[k for k in range(3000) if k % 3 != 1], [k for k in range(3000) if k % 3 != 0], [], [], []]
    assert listed == {k: by_kind[k % 5] for k in range(60)}
    assert {r.doc_id: (r.n, r.largest, r["first"]) for r in rows.collect()} == {
        k: (len(x), max(x, default=None), min(x, default=None)) for k, x in listed.items()
    }
    hits = winnowing.hits(documents, items)
    assert hits.columns == ["doc_id", "first", "window", "item_set"]
    assert hits.select("item_set").distinct().count() == 2  # of the first two passages; no document holds the third
    assert contamination(documents, items.limit(0), told=told).where("n = 0 and largest is null").count() == 60
