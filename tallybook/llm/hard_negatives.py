"""Hard negatives of anchors, by bounds along a spanning tree of the anchors.

Anchors are a stated set of queries, held against all rows in blocks of a
bounded size.  Each block has a spanning tree: every anchor hangs on the
nearest one already in the tree, or on the origin, which is its root.  For a
row ``c`` the score at an anchor differs from the score at its parent by at most
the length of the edge times the norm of ``c``, so an interval at the parent
gives one at the child.  A row is scored at an anchor only if its interval meets
the anchor's window; then the interval shrinks to the score.

One pass over the rows finds the positives of a block (the window is open
above, its lower end is the last of the best found so far), another one the
negatives (the window spans those of the positives).  Rows are never moved: a
task holds the block and some thousand rows, and returns a few rows an anchor.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import settled
from tallybook.session import ensure_checkpoint_dir

BLOCK_BYTES = 4 << 20  # of the vectors of a block of anchors
CELLS = 1 << 20  # pairs of an anchor and a row that are held at a time
EXACT = float(1 << 53)  # whole numbers below it are exact in floating point
DENSE = 0.25  # share of a chunk's rows from which an anchor is scored against the whole chunk

BEST = 5  # positives of an anchor, and negatives of a positive
TREE = "place int, parent int, edge double, vec_id bigint, label bigint, vector array<double>"
FOUND = "place int, positive int, score bigint, vec_id bigint"


def taking_part(embeddings: DataFrame, label: Column | None = None) -> DataFrame:
    """Rows (vec_id, label, vector) of whole numbers: each component times 256, rounded down.

    Rows with a NULL label or vector, or a component that is NULL or not
    finite, go.  ``label`` may replace the label that rows come with.
    """
    label = F.col("label") if label is None else label
    rows = embeddings.select("vec_id", label.cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # Kept as double: a whole number of any size that a double can hold.
    floor = "transform(vector, x -> if(abs(x) < 1e16, cast(floor(256 * x) as double), 256 * x)) as vector"
    return rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~odd).selectExpr("vec_id", "label", floor)


# -- trees ---------------------------------------------------------------------


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order in which anchors join the tree, each one's parent (a place in that order, or -1) and its edge's length.

    Prim's algorithm from the origin; a parent comes ahead of its children.
    """
    n = len(vectors)
    square = np.einsum("ij,ij->i", vectors, vectors)
    nearest, parent = square.copy(), np.full(n, -1)
    outside = np.ones(n, bool)
    order, parents = np.empty(n, np.int64), np.empty(n, np.int64)
    for place in range(n):
        k = int(np.argmin(np.where(outside, nearest, np.inf)))
        order[place], parents[place], outside[k] = k, parent[k], False
        away = square + square[k] - 2 * (vectors @ vectors[k])
        closer = outside & (away < nearest)
        nearest[closer], parent[closer] = away[closer], place
    whole = np.vstack([vectors[order], np.zeros((1, vectors.shape[1]))])  # the origin is at place -1
    edges = np.linalg.norm(whole[:-1] - whole[parents], axis=1)
    return order, parents, edges


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Vectors as rows, zeros where one is shorter; what lies beyond ``width`` is cut."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths())
    width = int(lengths.max(initial=0)) if width is None else width
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == lengths[0]).all():
        rows = flat.reshape(len(lengths), int(lengths[0]))
        if rows.shape[1] >= width:
            return rows[:, :width]
    matrix = np.zeros((len(lengths), width))
    for k, (stop, length) in enumerate(zip(np.cumsum(lengths), lengths)):
        taken = min(length, width)
        matrix[k, :taken] = flat[stop - length : stop - length + taken]
    return matrix


def _trees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, vec_id, label, vector), a block's rows together and few enough for a task."""
    current: list[pa.RecordBatch] = []
    for batch in batches:
        at = 0
        blocks = batch.column(0).to_numpy(zero_copy_only=False)
        for cut in [*(np.flatnonzero(np.diff(blocks)) + 1), len(blocks)]:
            part = batch.slice(at, cut - at)
            if current and len(part) and part.column(0)[0] != current[-1].column(0)[0]:
                yield from _tree(current)
                current = []
            if len(part):
                current.append(part)
            at = cut
    if current:
        yield from _tree(current)


def _tree(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(parts).combine_chunks()
    order, parents, edges = spanning_tree(_matrix(table["vector"]))
    rows = table.take(pa.array(order))
    columns = [
        rows["block"],
        pa.array(np.arange(len(order)), pa.int32()),
        pa.array(parents, pa.int32()),
        pa.array(edges),
        rows["vec_id"],
        rows["label"],
        rows["vector"],
    ]
    names = ["block", "place", "parent", "edge", "vec_id", "label", "vector"]
    yield from pa.table(dict(zip(names, columns))).to_batches()


def trees(anchors: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Anchors (vec_id, label, vector) with block, place, parent and edge.

    No block has more rows than fit ``block_bytes``: anchors are dealt out
    evenly, and what lies beyond in a partition starts another block.
    """
    count, width = anchors.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    rows = max(1, block_bytes // (8 * max(1, width)))
    blocks = max(1, -(-count // rows))
    dealt = settled(anchors.repartition(blocks).withColumn("at", F.monotonically_increasing_id()))
    place = (F.lit(1 << 33) - 1).cast("bigint")
    within = F.floor(F.col("at").bitwiseAND(place) / rows)
    block = F.shiftright("at", 33) + within * blocks
    numbered = dealt.select(block.cast("bigint").alias("block"), "vec_id", "label", "vector")
    grouped = numbered.repartition(blocks, "block").sortWithinPartitions("block", "vec_id", "label", "vector")
    return settled(grouped.mapInArrow(_trees, f"block bigint, {TREE}"))


# -- scoring -------------------------------------------------------------------


@dataclass(frozen=True)
class Block:
    """The anchors of a tree, parents first, and each one's wanted scores."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parents: np.ndarray
    edges: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> Block:
        rows = rows.sort_by("place")
        named = [rows[c].to_numpy() for c in ("vec_id", "label", "parent", "edge")]
        return cls(named[0], named[1], _matrix(rows["vector"]), *named[2:])

    def levels(self) -> list[np.ndarray]:
        """Places by their distance from the root."""
        depth = np.zeros(len(self.parents), np.int64)
        for k, parent in enumerate(self.parents):
            depth[k] = depth[parent] + 1 if parent >= 0 else 0
        return [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=-1)) + 1)]


class Best:
    """The best ``BEST`` rows so far: by score, then by id, NULL ids last."""

    def __init__(self, low: float = -np.inf, high: float = np.inf):
        self.low, self.high = low, high
        self.rows: list[tuple[int, bool, int]] = []  # minus the score, whether the id is NULL, the id

    @property
    def floor(self) -> float:
        """Scores below it are of no use."""
        return max(self.low, -self.rows[-1][0]) if len(self.rows) == BEST else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        usable = np.flatnonzero((scores >= self.floor) & (scores <= self.high))
        if len(usable) > BEST:
            least = np.sort(scores[usable])[-BEST]
            usable = usable[scores[usable] >= least]
            if len(usable) > BEST and scores.dtype != object:
                usable = usable[np.lexsort((ids[usable], nameless[usable], -scores[usable]))[:BEST]]
        found = [(-int(scores[k]), bool(nameless[k]), int(ids[k])) for k in usable]
        self.rows = sorted(self.rows + found)[:BEST]


class Scorer:
    """Holds chunks of rows against a block; ``rescored`` of ``met`` pairs needed a score."""

    def __init__(self, block: Block):
        self.block, self.levels = block, block.levels()
        self.largest = float(np.abs(block.vectors).max(initial=0)) * max(1, block.vectors.shape[1])
        self.met = self.rescored = 0

    def scores(self, vectors: np.ndarray, anchors: np.ndarray) -> np.ndarray:
        """Inner products, a row an anchor, as exact whole numbers."""
        if self.largest * float(np.abs(vectors).max(initial=0)) < EXACT:
            return anchors @ vectors.T
        whole = [[[int(x) for x in v] for v in side] for side in (anchors, vectors)]
        result = np.empty((len(anchors), len(vectors)), object)
        for i, a in enumerate(whole[0]):
            result[i] = [sum(x * y for x, y in zip(a, c)) for c in whole[1]]
        return result

    def walk(self, vectors: np.ndarray, usable, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(place, rows, their scores) of the rows whose interval meets the window [low, high] of an anchor.

        ``usable(places)`` says which rows an anchor may have at all.
        """
        block, n = self.block, len(vectors)
        norms = np.linalg.norm(vectors, axis=1) * (1 + 1e-9)
        at_parent: dict[int, tuple[np.ndarray, np.ndarray]] = {-1: (np.zeros(n), np.zeros(n))}
        for level in self.levels:
            parents = block.parents[level]
            spread = block.edges[level, None] * norms[None, :] + 1e-6
            lower = np.stack([at_parent[p][0] for p in parents]) - spread
            upper = np.stack([at_parent[p][1] for p in parents]) + spread
            wanted = (upper >= low[level, None]) & (lower <= high[level, None]) & usable(level)
            self.met += wanted.size
            self.rescored += int(wanted.sum())
            share = wanted.mean(axis=1)
            many = np.flatnonzero(share >= DENSE)
            dense = dict(zip(many.tolist(), self.scores(vectors, block.vectors[level[many]]))) if len(many) else {}
            for k, place in enumerate(level.tolist()):
                rows = np.flatnonzero(wanted[k])
                if k in dense:
                    lower[k] = upper[k] = dense[k].astype(float)
                    yield place, rows, dense[k][rows]
                elif len(rows):
                    exact = self.scores(vectors[rows], block.vectors[place : place + 1])[0]
                    lower[k, rows] = upper[k, rows] = exact.astype(float)
                    yield place, rows, exact
            at_parent = {place: (lower[k], upper[k]) for k, place in enumerate(level.tolist())}


def _chunks(batches: Iterable[pa.RecordBatch], block: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, whether they are NULL, labels and vectors of some rows."""
    width, size = block.vectors.shape[1], max(64, CELLS // max(1, len(block.ids)))
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            nameless = part.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            yield ids, nameless, part.column(1).to_numpy(zero_copy_only=False), _matrix(part.column(2), width)


def _clamped(score: int) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, score))


def _result(found: dict[tuple[int, int], Best]) -> Iterator[pa.RecordBatch]:
    rows = [(place, k, _clamped(-s), None if n else i) for (place, k), best in found.items() for s, n, i in best.rows]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    columns = list(zip(*rows)) if rows else [[]] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["place", "positive", "score", "vec_id"])


def best_positives(batches: Iterable[pa.RecordBatch], block: Block) -> Iterator[pa.RecordBatch]:
    """The best rows of an anchor's label among the given ones, without rows of its own id."""
    scorer, best = Scorer(block), [Best() for _ in block.ids]
    high = np.full(len(best), np.inf)
    for ids, nameless, labels, vectors in _chunks(batches, block):

        def usable(places: np.ndarray) -> np.ndarray:
            own = (ids[None, :] == block.ids[places, None]) & ~nameless[None, :]
            return (labels[None, :] == block.labels[places, None]) & ~own

        low = np.array([float(b.floor) for b in best])
        for place, rows, scores in scorer.walk(vectors, usable, low, high):
            best[place].add(scores, ids[rows], nameless[rows])
    yield from _result({(k, 0): b for k, b in enumerate(best)})


def best_negatives(batches: Iterable[pa.RecordBatch], block: Block, positives: list[list[int]]) -> Iterator[pa.RecordBatch]:
    """The best rows of other labels in the window of each positive score (``positives`` by place)."""
    scorer = Scorer(block)
    # 80 p <= 100 n <= 100 p; for p < 0 no score is in between.
    best = [[Best(-((-4 * p) // 5), p) for p in scores] for scores in positives]
    high = np.array([max((b.high for b in x if b.low <= b.high), default=-np.inf) for x in best], float)
    for ids, nameless, labels, vectors in _chunks(batches, block):

        def usable(places: np.ndarray) -> np.ndarray:
            return labels[None, :] != block.labels[places, None]

        low = np.array([min((float(b.floor) for b in x if b.low <= b.high), default=np.inf) for x in best])
        for place, rows, scores in scorer.walk(vectors, usable, low, high):
            for one in best[place]:
                one.add(scores, ids[rows], nameless[rows])
    yield from _result({(place, k): one for place, x in enumerate(best) for k, one in enumerate(x)})


# -- jobs ----------------------------------------------------------------------


def _ranked(found: DataFrame, out: str) -> DataFrame:
    """The best of what the tasks found, numbered from 1."""
    order = Window.partitionBy("place", "positive").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn(out, F.row_number().over(order)).where(F.col(out) <= BEST)


def mine(rows: DataFrame, anchors: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` and ``anchors`` come from :func:`taking_part`.  A row's score is its
    inner product with the anchor.  Positives are the first 5 rows of the
    anchor's label by score, then by the smaller id; negatives of a positive are
    the first 5 rows of other labels between 80 % of its score and all of it.
    Rows of the anchor's own id are not its positives.  Repeated rows, and
    repeated anchors, count each; rows with a NULL id come after all others; a
    shorter vector is filled up with zeros; scores beyond 64 bits are reported
    as the nearest such number.  Without anchors or positives there are no rows.

    The blocks follow each other, and each one's result is written to the
    shared folder.  What is broadcast is one block.  Tasks return up to 25 rows
    an anchor, so the rows are dealt to no more tasks than some for each core.
    """
    spark = rows.sparkSession
    planted = trees(anchors, block_bytes)
    tasks = 4 * max(1, spark.sparkContext.defaultParallelism)
    rows = rows.coalesce(tasks)
    folder = f"{ensure_checkpoint_dir(spark)}/hard-negatives-{uuid4().hex}"
    for (number,) in planted.select("block").distinct().orderBy("block").toLocalIterator():
        tree = planted.where(F.col("block") == number)
        _mined(rows, tree).write.parquet(f"{folder}/{number}")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if planted.isEmpty():
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/*")


def _mined(rows: DataFrame, tree: DataFrame) -> DataFrame:
    block = Block.of(tree.drop("block").toArrow())
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(block)
    found = rows.mapInArrow(lambda batches: best_positives(batches, sent.value), FOUND)
    positives = settled(_ranked(found, "number").select("place", F.col("number").alias("positive"), "score", "vec_id"))
    scores: list[list[int]] = [[] for _ in block.ids]
    for place, score in positives.orderBy("place", "positive").select("place", "score").toLocalIterator():  # 5 an anchor
        scores[place].append(score)
    wanted = spark.sparkContext.broadcast(scores)
    found = rows.mapInArrow(lambda batches: best_negatives(batches, sent.value, wanted.value), FOUND)
    negatives = _ranked(found, "rank").select(
        "place", (F.col("positive") + 1).alias("positive"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    named = positives.select("place", "positive", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    anchors = tree.select("place", F.col("vec_id").alias("anchor_id"))
    joined = negatives.join(named, ["place", "positive"]).join(anchors, "place")
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
