from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tallybook.llm import toxicity
from tallybook.llm.hashing import WordHashes, grams
from tallybook.llm.queries import QUERIES


def test_grams_are_those_of_the_text():
    hashes = WordHashes()
    one, two = hashes.of("A b, c"), hashes.of("a B c")
    assert (one == two).all()
    # three words, two pairs, one pair over a gap
    assert len(grams(one, 2, 1, 20)) == 6 and len(grams(hashes.of("a"), 2, 1, 20)) == 1 and len(grams(hashes.of(""), 2, 1, 20)) == 0
    assert set(grams(hashes.of("a b"), 2, 1, 20)) < set(grams(hashes.of("a b c"), 2, 1, 20))


def test_ftrl_weights_are_sparse_and_tell():
    model = toxicity.Ftrl(100)
    draw = random.Random(0)
    for _ in range(400):
        label = draw.randrange(2)
        noise = [draw.randrange(10, 99) for _ in range(5)]
        model.learn(np.unique([label, *noise, 99]), label)
    weights = model.weights(slice(None))
    assert weights[1] > 0 > weights[0] and np.count_nonzero(weights[10:99]) < 20


def test_query(spark, medium):
    documents = spark.read.parquet(f"{medium}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{medium}/labels.parquet").collect()}
    rows = QUERIES["op2_toxicity"](spark, medium).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in documents.collect())
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    assert right >= 0.9 * len(held)


def test_held_out_labels_are_not_learned_from(spark, small):
    documents, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(toxicity.fold() == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.train(documents, x.withColumn("toxic", F.col("toxic").cast("int"))) for x in (labels, turned))
    assert (one.index == two.index).all() and (one.weight == two.weight).all()


def test_edge_cases(spark, edge_documents, no_documents):
    labels = spark.createDataFrame([(None, 1), (1, None), (3, 1), (3, 0), (4, 0), (4, 5)], "doc_id bigint, toxic int")
    model = toxicity.train(edge_documents, labels)
    rows = toxicity.scored(edge_documents, model).collect()
    assert len(rows) == edge_documents.count() and all(0 <= r.score <= 1 for r in rows)
    empty = toxicity.train(no_documents, labels.limit(0))
    assert {r.score for r in toxicity.scored(edge_documents, empty).collect()} == {0.5}
    assert toxicity.scored(no_documents, model).count() == 0
    assert toxicity.clean_documents(edge_documents, model).columns == edge_documents.columns
