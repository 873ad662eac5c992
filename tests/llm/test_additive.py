from __future__ import annotations

import numpy as np
import pytest

from tallybook.llm import additive
from tallybook.llm.additive import BINS, STATISTICS, fit, pair_tree, scored, statistics, train, tree
from tallybook.llm.queries import op12_additive
from tests.llm.conftest import PLAIN, counted


def even_edges(values: np.ndarray) -> list[np.ndarray]:
    return [np.quantile(values[:, f], np.arange(1, BINS) / BINS) for f in range(values.shape[1])]


def test_tree_cuts_where_the_step_is():
    residual, weight = np.r_[np.full(10, 5.0), np.full(22, -2.0)], np.full(BINS, 20.0)
    step = tree(residual, weight, leaves=2)
    assert len(set(step)) == 2 and step[9] > 0 > step[10]
    assert not tree(np.zeros(BINS), weight).any()


def test_pair_tree_finds_an_exclusive_or():
    grid = np.outer(np.r_[np.ones(4), -np.ones(4)], np.r_[np.ones(3), -np.ones(5)]) * 10
    gain, step = pair_tree(grid, np.full((8, 8), 5.0))
    assert gain > 0 and (np.sign(step) == np.sign(grid)).all()
    assert pair_tree(np.zeros((8, 8)), np.full((8, 8), 5.0))[0] == 0


def test_additive_effects_and_an_interaction_are_learned():
    draw = np.random.default_rng(0)
    values = draw.random((6000, 4))
    odds = 6 * (values[:, 0] - 0.5) + 4 * np.where((values[:, 1] > 0.5) == (values[:, 2] > 0.5), 1, -1)
    labels = (draw.random(6000) < 1 / (1 + np.exp(-odds))).astype(int)
    model = fit(values[:4000], labels[:4000], even_edges(values[:4000]))
    assert (1, 2) in model.pairs
    right = ((model.scores(values[4000:]) >= 0.5) == labels[4000:]).mean()
    best = ((odds[4000:] >= 0) == labels[4000:]).mean()
    assert right > best - 0.03
    alone = additive.Model(model.bias, model.edges, model.tables, {})
    assert ((alone.scores(values[4000:]) >= 0.5) == labels[4000:]).mean() < right - 0.1


def test_scores_are_sums_of_table_entries():
    draw = np.random.default_rng(1)
    values, labels = draw.random((800, 3)), draw.integers(0, 2, 800)
    model = fit(values, labels, even_edges(values))
    for row, score in zip(values[:50], model.scores(values[:50])):
        at = [int((edges < x).sum()) for x, edges in zip(row, model.edges)]
        total = model.bias + sum(t[k] for t, k in zip(model.tables, at))
        total += sum(t[at[a] * 8 // BINS, at[b] * 8 // BINS] for (a, b), t in model.pairs.items())
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_statistics():
    def named(text):
        return dict(zip(STATISTICS, statistics(text)))

    assert statistics(None) == statistics("") == statistics(" \n\t ") == [0.0] * len(STATISTICS)
    found = named("The cat, the CAT!! sat.\nThe cat, the CAT!! sat.\n\n*** a a a a 12")
    assert found["repeated_lines_share"] == pytest.approx(1 / 3)
    assert found["same_as_before_share"] == pytest.approx(3 / 16)
    assert found["longest_repeat_share"] == pytest.approx(4 / 16)
    assert found["distinct_share"] == pytest.approx(8 / 16)
    assert found["loud_per_word"] == pytest.approx(4 / 16) and found["symbols_per_word"] == pytest.approx(3 / 16)
    assert found["one_mark_share"] == pytest.approx(1 / 16)
    assert all(np.isfinite(v) for v in named("x" * 100_000 + " " + "é " * 5 + "\0").values())


def test_held_out_accuracy(spark, medium):
    rows = op12_additive(spark, medium).join(spark.read.parquet(f"{medium}/labels.parquet"), "doc_id")
    rows = rows.where("held_out").select("predicted", "quality").collect()
    good = [p for p, q in rows if q == 1]
    bad = [p for p, q in rows if q == 0]
    assert len(rows) > 50 and sum(good) >= 0.97 * len(good) and sum(bad) <= 0.15 * len(bad)


def test_rows_and_types(spark, medium):
    rows = op12_additive(spark, medium)
    assert dict(rows.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    assert rows.count() == spark.read.parquet(f"{medium}/documents.parquet").count()
    assert rows.where("score < 0 or score > 1 or predicted <> cast(score >= 0.7 as int)").isEmpty()
    held = rows.selectExpr("held_out <> (crc32(cast(doc_id as string)) % 4 = 2) as wrong").where("wrong")
    assert held.isEmpty()


def test_odd_documents(spark, edge_documents, no_documents):
    labels = spark.createDataFrame([(4, 0, 1), (3, 1, 0), (5, None, 1), (None, 1, 1), (2, 7, 0)], "doc_id bigint, quality int, toxic int")
    model = train(edge_documents, labels)
    rows = scored(edge_documents, model).collect()
    assert len(rows) == edge_documents.count()
    by_text = counted((r["doc_id"], r["score"]) for r in rows)
    assert by_text[3, next(r["score"] for r in rows if r["doc_id"] == 3)] == 2
    assert scored(no_documents, model).count() == 0
    unlearned = train(no_documents, labels)
    assert {r["score"] for r in scored(edge_documents, unlearned).collect()} == {0.5}


def test_same_model_from_any_partitions(spark, medium):
    documents = spark.read.parquet(f"{medium}/documents.parquet")
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    one, two = train(documents, labels), train(documents.repartition(7), labels.repartition(3))
    texts = [[*statistics(PLAIN)], [*statistics("A A A A !! B B ## " * 30)]]
    assert np.allclose(one.scores(np.array(texts)), two.scores(np.array(texts)))
