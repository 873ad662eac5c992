"""Quality of texts by a generalised additive model with pairwise interactions.

A text becomes a few statistics.  Each statistic has a table of log odds by bin,
and some pairs of statistics have one by both bins; the score is the bias plus
one entry of each table.  Tables are learned by cyclic boosting: statistic after
statistic, a shallow tree over its bins is fitted to what the others leave, and
added in part; then pairs, chosen by what a tree over both would still gain, take
their turns in the same way.

Labelled rows are dealt to shards of a bounded size, one task learns from each,
and the mean of their tables is the model.  Scoring looks up bins of a batch of
texts at once, with no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm import common
from tallybook.llm.common import settled
from tallybook.llm.toxicity import HELD_OUT, fold

SAMPLE = 16_384  # about so many labelled rows are learned from, chosen by a hash of doc_id
SHARD = 8_192  # labelled rows of a shard
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 100, 8
RATE, LEAVES, LEAST_LEAF, SHRINK = 0.1, 4, 5.0, 1.0
LEAST_WEIGHT = 0.05  # of a row in a leaf, however sure its score
THRESHOLD = 0.7

WORD = re.compile(common.WORD)
CONTENT = re.compile(r"\w", re.ASCII)

# A byte's kind, as bits of a table over the 256 values of UTF-8.
LETTER, UPPER, DIGIT, STOP, COMMA, SYMBOL, LOUD, BLANK = (1 << k for k in range(8))

STATISTICS = (
    "log_words",
    "word_chars",
    "upper_share",
    "digit_share",
    "stops_per_word",
    "commas_per_word",
    "symbols_per_word",
    "loud_per_word",
    "odd_words_share",
    "one_mark_share",
    "same_as_before_share",
    "distinct_share",
    "repeated_pairs_share",
    "repeated_triples_share",
    "longest_repeat_share",
    "repeated_lines_share",
    "words_per_line",
    "commonest_word_share",
)


def _kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    for value in range(256):
        c = chr(value) if value < 128 else "é"  # bytes beyond ASCII are parts of letters
        kinds[value] = (
            LETTER * c.isalpha()
            | UPPER * c.isupper()
            | DIGIT * c.isdigit()
            | STOP * (c in ".?;:")
            | COMMA * (c in ",")
            | SYMBOL * (c in "#*$%&|<>@^~_=+{}[]\\/")
            | LOUD * (c in "!")
            | BLANK * (c in common.BLANKS)
        )
    return kinds


KINDS = _kinds()


def statistics(text: str | None) -> list[float]:
    """The values of ``STATISTICS``; all zero for a text without words."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)

    def bytes_of(kind: int) -> int:
        return int(counts[(KINDS & kind) > 0].sum())

    letters, blanks = bytes_of(LETTER), bytes_of(BLANK)
    known: dict[str, int] = {}
    numbers = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    odd = one = 0
    per_word = np.bincount(numbers)
    for word, times in zip(known, per_word.tolist()):
        if not word.isalpha():
            if not word[:-1].isalpha():
                odd += times
                one += times * (CONTENT.search(word) is None and word.isascii())
    same = numbers[1:] == numbers[:-1]
    edges = np.flatnonzero(np.concatenate(([True], ~same, [True])))
    lines = [line for line in text.split("\n") if line.strip(common.BLANKS)]
    return [
        float(np.log1p(n)),
        (sum(counts) - blanks) / n,
        bytes_of(UPPER) / max(1, letters),
        bytes_of(DIGIT) / max(1, letters),
        bytes_of(STOP) / n,
        bytes_of(COMMA) / n,
        bytes_of(SYMBOL) / n,
        bytes_of(LOUD) / n,
        odd / n,
        one / n,
        float(same.sum()) / n,
        len(known) / n,
        _repeated(numbers, 2),
        _repeated(numbers, 3),
        int(np.diff(edges).max()) / n,
        1 - len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        int(per_word.max()) / n,
    ]


def _repeated(numbers: np.ndarray, length: int) -> float:
    """Share of the word n-grams of a length that occurred earlier in the text."""
    if len(numbers) < length:
        return 0.0
    grams = numbers[: len(numbers) - length + 1]
    for k in range(1, length):
        grams = grams * 1_000_003 + numbers[k : len(numbers) - length + 1 + k]  # wraps around, as a hash
    return 1 - len(np.unique(grams)) / len(grams)


def _values(texts: pa.Array) -> np.ndarray:
    rows = [statistics(text.as_py()) for text in texts]
    return np.array(rows, np.float64).reshape(len(rows), len(STATISTICS))


# -- model ---------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """``edges[f]`` cuts statistic f into bins, ``tables[f]`` has their log odds.

    ``pairs`` maps two statistics to a table by the coarser bins of both.
    """

    bias: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray]

    def scores(self, values: np.ndarray) -> np.ndarray:
        bins = _binned(values, self.edges)
        total = np.full(len(values), self.bias)
        for f, table in enumerate(self.tables):
            total += table[bins[:, f]]
        for (a, b), table in self.pairs.items():
            total += table[_coarse(bins[:, a]), _coarse(bins[:, b])]
        return _chance(total)


def _chance(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(log_odds, -35, 35)))


def _binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, values[:, f], side="left") for f, e in enumerate(edges)], axis=1)


def _coarse(bins: np.ndarray) -> np.ndarray:
    return bins * PAIR_BINS // BINS


def _gain(residual: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return residual * residual / (weight + SHRINK)


def _best_cut(residual: np.ndarray, weight: np.ndarray) -> tuple[float, int]:
    """The cut of some bins that gains most, and the gain; no cut leaves too little weight on a side."""
    left, left_weight = np.cumsum(residual)[:-1], np.cumsum(weight)[:-1]
    if not len(left):
        return 0.0, 0
    whole, whole_weight = residual.sum(), weight.sum()
    gain = _gain(left, left_weight) + _gain(whole - left, whole_weight - left_weight) - _gain(whole, whole_weight)
    gain[(left_weight < LEAST_LEAF) | (whole_weight - left_weight < LEAST_LEAF)] = 0.0
    cut = int(np.argmax(gain))
    return float(gain[cut]), cut + 1


def tree(residual: np.ndarray, weight: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """A step over the bins of a statistic: a tree grown leaf by leaf, by what each cut gains."""
    parts = [(0, len(residual))]
    while len(parts) < leaves:
        options = [(*_best_cut(residual[a:b], weight[a:b]), a, b) for a, b in parts]
        gain, cut, a, b = max(options)
        if gain <= 0:
            break
        parts.remove((a, b))
        parts += [(a, a + cut), (a + cut, b)]
    step = np.zeros(len(residual))
    for a, b in parts:
        step[a:b] = residual[a:b].sum() / (weight[a:b].sum() + SHRINK)
    return step


def pair_tree(residual: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """What is gained by, and the step of, a tree over two statistics: one cut of either, then one of the other on each side."""
    best, step = 0.0, np.zeros_like(residual)
    for turned in (False, True):
        r, w = (residual.T, weight.T) if turned else (residual, weight)
        whole = _gain(r.sum(), w.sum())
        for cut in range(1, len(r)):
            gain, found = -float(whole), np.zeros_like(r)
            for side in (slice(0, cut), slice(cut, None)):
                rows, weights = r[side].sum(axis=0), w[side].sum(axis=0)
                if weights.sum() < LEAST_LEAF:
                    break
                more, at = _best_cut(rows, weights)
                gain += more + float(_gain(rows.sum(), weights.sum()))
                parts = (slice(0, at), slice(at, None)) if more > 0 else (slice(None),)
                for part in parts:
                    found[side, part] = rows[part].sum() / (weights[part].sum() + SHRINK)
            else:
                if gain > best:
                    best, step = gain, found.T if turned else found
    return best, step


def fit(values: np.ndarray, labels: np.ndarray, edges: list[np.ndarray]) -> Model:
    """Learn the tables from rows of statistics and their labels, 0 or 1."""
    bins = _binned(values, edges)
    mean = (labels.sum() + 0.5) / (len(labels) + 1)
    bias = float(np.log(mean / (1 - mean)))
    total = np.full(len(labels), bias)
    tables = [np.zeros(BINS) for _ in edges]

    def sums(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        chance = _chance(total)
        return np.bincount(at, labels - chance, size), np.bincount(at, np.maximum(chance * (1 - chance), LEAST_WEIGHT), size)

    for _ in range(ROUNDS):
        for f, table in enumerate(tables):
            step = RATE * tree(*sums(bins[:, f], BINS))
            table += step
            total += step[bins[:, f]]

    coarse, grid = _coarse(bins), (PAIR_BINS, PAIR_BINS)

    def fitted(a: int, b: int) -> tuple[float, np.ndarray]:
        residual, weight = sums(coarse[:, a] * PAIR_BINS + coarse[:, b], PAIR_BINS**2)
        return pair_tree(residual.reshape(grid), weight.reshape(grid))

    gains = {pair: fitted(*pair)[0] for pair in combinations(range(len(edges)), 2)}
    chosen = sorted(gains, key=lambda pair: (-gains[pair], pair))[:PAIRS]
    pairs = {pair: np.zeros(grid) for pair in chosen if gains[pair] > 0}
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in pairs.items():
            step = RATE * fitted(a, b)[1]
            table += step
            total += step[coarse[:, a], coarse[:, b]]
    return Model(bias, edges, tables, pairs)


def mean_of(models: list[Model], edges: list[np.ndarray]) -> Model:
    """The mean of all tables; without models every score is one half."""
    n = max(1, len(models))
    pairs: dict[tuple[int, int], np.ndarray] = {}
    for model in models:
        for pair, table in model.pairs.items():
            pairs[pair] = pairs.get(pair, 0) + table / n
    tables = [sum((m.tables[f] for m in models), np.zeros(BINS)) / n for f in range(len(edges))]
    return Model(sum(m.bias for m in models) / n, edges, tables, pairs)


# -- jobs ----------------------------------------------------------------------


def _measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Statistics of the second column, as an array; further columns pass."""
    for batch in batches:
        values = _values(batch.column(1))
        offsets = pa.array(np.arange(len(values) + 1) * len(STATISTICS), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists, *batch.columns[2:]], ["doc_id", "values", "quality"])


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit to ``labels`` (doc_id, quality), without the rows of the held-out fold.

    Labels other than 0 and 1 and NULL ids are left out; of several labels of a
    document the lowest counts; without labels every score is one half.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (fold() != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    rows = known.count()
    share = min(1.0, sample / max(1, rows))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    shards = max(1, -(-min(rows, sample) // SHARD))
    dealt = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # about `sample` ids
    measured = settled(dealt.mapInArrow(_measured, "doc_id bigint, values array<double>, quality int"))
    cuts = [k / BINS for k in range(1, BINS)]
    at = measured.select(*[F.col("values")[f].alias(name) for f, name in enumerate(STATISTICS)])
    found = at.agg(*[F.percentile_approx(name, cuts, 10_000).alias(name) for name in STATISTICS]).first()
    edges = [np.unique(np.array(found[name] or [], np.float64)) for name in STATISTICS]

    def learned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, None) if (batches := list(batches)) else None
        if rows is None or not len(rows):
            return
        values = rows["values"].combine_chunks().flatten().to_numpy().reshape(len(rows), len(STATISTICS))
        model = fit(values, rows["quality"].to_numpy(), edges)
        columns = [(-1, -1, [model.bias]), *((f, -1, t) for f, t in enumerate(model.tables))]
        columns += [(a, b, t.ravel()) for (a, b), t in model.pairs.items()]
        first, second, tables = zip(*columns)
        shard = np.full(len(first), rows["shard"][0].as_py(), np.int64)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64())]
        arrays = [pa.array(x, k) for x, k in zip([shard, first, second, [list(t) for t in tables]], kinds)]
        yield pa.RecordBatch.from_arrays(arrays, ["shard", "a", "b", "table"])

    shard = F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(shards))
    by_shard = measured.select(shard.cast("int").alias("shard"), "doc_id", "values", "quality")
    by_shard = by_shard.repartitionById(shards, "shard").sortWithinPartitions("shard", "doc_id", "values")
    parts = by_shard.mapInArrow(learned, "shard bigint, a bigint, b bigint, table array<double>").toPandas()
    models = [_assembled(part, edges) for _, part in sorted(parts.groupby("shard"))]
    return mean_of(models, edges)


def _assembled(part, edges: list[np.ndarray]) -> Model:
    """A model from the rows a task returns."""
    tables = {(int(a), int(b)): np.array(t, np.float64) for a, b, t in zip(part["a"], part["b"], part["table"])}
    pairs = {k: t.reshape(PAIR_BINS, PAIR_BINS) for k, t in sorted(tables.items()) if k[1] >= 0}
    return Model(float(tables[-1, -1][0]), edges, [tables[f, -1] for f in range(len(edges))], pairs)


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted.

    NULL and empty texts have the score of a text without words.  Repeated rows
    each give a row; other columns are ignored.
    """

    def scores(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = model.scores(_values(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    rows = documents.select("doc_id", "text").mapInArrow(scores, "doc_id bigint, score double")
    held_out = F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out")
    return rows.select("doc_id", held_out, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
