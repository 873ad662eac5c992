"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Labelled rows are dealt to shards; each is streamed through one task, which
updates its coordinates one document at a time with per-coordinate rates, and
returns the weights that L1 leaves (few).  The mean of the shards' weights is
the model: at most ``2 ** BITS`` pairs of numbers, usually some hundreds, sent
to every task that scores.  Scoring needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tallybook.llm.hashing import WordHashes, grams

SAMPLE = 16_384  # about so many labelled rows are learned from, chosen by a hash of doc_id
SHARD = 4_096  # labelled rows of a shard
EPOCHS = 3
BITS = 20
UP_TO, SKIPS = 2, 1
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.1
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


@dataclass(frozen=True)
class Model:
    """Weights that are not zero, by hashed gram; the bias is the last index."""

    index: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        weights = np.zeros((1 << BITS) + 1, np.float32)
        weights[self.index] = self.weight
        return weights


class Ftrl:
    """Follow the regularised leader, with a rate of its own for each coordinate."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        step = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, step)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += error - (np.sqrt(n + error * error) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + error * error


def features(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The distinct grams of a text."""
    return np.unique(grams(hashes.of(text or ""), UP_TO, SKIPS, BITS))


def _train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, text, toxic), each shard's together and in the order to learn from."""
    hashes, current, model = WordHashes(), None, None
    for batch in batches:
        for shard, text, toxic in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if shard != current:
                if model is not None:
                    yield _result(current, model)
                current, model = shard, Ftrl((1 << BITS) + 1)
            model.learn(np.append(features(text, hashes), 1 << BITS), toxic)
    if model is not None:
        yield _result(current, model)


def _result(shard: int, model: Ftrl) -> pa.RecordBatch:
    weights = model.weights(slice(None))
    index = np.flatnonzero(weights)
    shards = np.full(len(index), shard, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(shards), pa.array(index), pa.array(weights[index])], ["shard", "index", "weight"])


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit to ``labels`` (doc_id, toxic), without the rows of the held-out fold.

    Labels other than 0 and 1 and NULL ids are left out; of several labels of a
    document the highest counts; without labels every score is one half.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold() != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = known.count()
    share = min(1.0, sample / max(1, rows))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    shards = max(1, -(-min(rows, sample) // SHARD))
    order = F.xxhash64(F.lit("order"), "doc_id")
    dealt = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # about `sample` ids
    dealt = dealt.select(F.pmod(order, F.lit(shards)).alias("shard"), "text", "toxic", "doc_id", order.alias("order"))
    dealt = dealt.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(EPOCHS))))
    dealt = dealt.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "epoch", "order", "doc_id", "text")
    weights = dealt.select("shard", "text", "toxic").mapInArrow(_train, "shard bigint, index bigint, weight double")
    found = weights.groupBy("index").agg((F.sum("weight") / shards).alias("weight")).toPandas()
    found = found.sort_values("index")
    return Model(found["index"].to_numpy(np.int64), found["weight"].to_numpy(np.float32))


def score(model: Model, text: str = "text") -> Column:
    """Chance that a text is toxic; a NULL or empty one has the bias alone."""

    @pandas_udf("double")
    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, hashes = model.dense(), WordHashes()
        for texts in parts:
            yield pd.Series([_score(x, weights, hashes) for x in texts], dtype="float64")

    return scores(F.col(text))


def _score(text: str | None, weights: np.ndarray, hashes: WordHashes) -> float:
    found = grams(hashes.of(text or ""), UP_TO, SKIPS, BITS)
    found = np.unique(found[weights[found] != 0])
    total = float(weights[found].sum(dtype=np.float64) + weights[1 << BITS])
    return float(1 / (1 + np.exp(-np.clip(total, -35, 35))))


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted."""
    rows = documents.select("doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), score(model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def clean_documents(documents: DataFrame, model: Model) -> DataFrame:
    """The documents not predicted toxic, with all their columns."""
    return documents.where(score(model) < THRESHOLD)
