from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parity.compare import connect
from tallybook.llm import hard_negatives
from tallybook.llm.hard_negatives import Block, Scorer, mine, spanning_tree, taking_part
from tallybook.llm.queries import ORACLES, op11_hard_negatives
from tests.llm.conftest import counted

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, place int, block int"


def plain(rows: list[tuple]) -> list[tuple]:
    """Every anchor against every row."""
    used = []
    for vec_id, vector, label, *_ in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            used.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    found = []
    for k, (a, label, v) in enumerate(used):
        if a is None or a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i is None, i or 0, l) for i, l, w in used if i != a]
        for s, nameless, i, _ in sorted(r for r in scored if r[3] == label)[:5]:
            near = sorted(r for r in scored if r[3] != label and 80 * -s <= 100 * -r[0] <= 100 * -s)
            for rank, (t, other_nameless, j, _) in enumerate(near[:5], 1):
                found.append((a, None if nameless else i, rank, None if other_nameless else j, -s, -t))
    return found


def mined(spark, rows: list[tuple], parts: int = 3, block_bytes: int = 1 << 20):
    table = spark.createDataFrame([(*r, 0.5, 1, 2) for r in rows], SCHEMA).repartition(parts)
    used = taking_part(table)
    return counted(mine(used, used.where("vec_id % 100 = 0"), block_bytes).collect())


def vectors(seed: int, n: int, spread: float) -> list[tuple]:
    """Copies around a few centres; many ties."""
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for k in range(n):
        centre = draw.choice(centres)
        rows.append((k * 10, [x + draw.choice([0, 0, spread]) * draw.gauss(0, 1) for x in centre], draw.randrange(3)))
    return rows


@pytest.mark.parametrize("seed,spread", [(0, 0.0), (1, 0.02), (2, 0.5), (3, 3.0)])
def test_same_as_every_pair(spark, seed, spread):
    rows = vectors(seed, 300, spread)
    assert mined(spark, rows) == counted(plain(rows))


def test_blocks_make_no_difference(spark):
    rows = vectors(7, 240, 0.3)
    assert mined(spark, rows, block_bytes=48 * 4) == counted(plain(rows))


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = vectors(5, 120, 0.2)
    rows += [(100_000, None, 1), (100_100, [1.0] * 6, None), (200_000, [nan] * 6, 1), (300_000, [inf] + [1.0] * 5, 2)]
    rows += [(400_000, [None] + [1.0] * 5, 1), (None, rows[0][1], rows[0][2]), (None, rows[1][1], rows[1][2])]
    rows += [(500_000, [], 1), (600_000, [0.4, -0.2], 0), (700_000, [3.0] * 9, 2), rows[10], rows[10], rows[20]]
    assert mined(spark, rows) == counted(plain(rows))


def test_numbers_beyond_floating_point(spark):
    draw = random.Random(3)
    rows = [(k * 50, [draw.choice([1e7, -3e6, 77.0]) * draw.random() for _ in range(4)], draw.randrange(2)) for k in range(40)]
    assert mined(spark, rows) == counted(plain(rows))


def test_no_rows_and_no_anchors(spark):
    assert mined(spark, []) == {}
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == {}
    assert mined(spark, [(0, [1.0], 1)]) == {}


def test_tree_hangs_each_anchor_on_the_nearest_ahead():
    points = np.random.default_rng(0).normal(size=(60, 3)) * 50
    order, parents, edges = spanning_tree(points)
    assert sorted(order) == list(range(60)) and all(p < k for k, p in enumerate(parents))
    placed = points[order]
    ends = np.vstack([placed, np.zeros(3)])[parents]
    assert np.allclose(np.linalg.norm(placed - ends, axis=1), edges)
    # A spanning tree is least if no other edge across a cut is shorter.
    for k in range(60):
        away = np.linalg.norm(np.vstack([placed[:k], np.zeros(3)])[:, None] - placed[None, k:], axis=2)
        assert edges[k] == pytest.approx(away.min())


def test_bounds_hold_and_save_scores():
    """Near copies of few vectors: most rows need no score, and none in the window is missed."""
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(8, 16)) * 100
    rows = np.floor(np.repeat(centres, 200, axis=0) + draw.normal(size=(1600, 16)))
    anchors = rows[::20]
    order, parents, edges = spanning_tree(anchors)
    block = Block(np.arange(len(order)), np.zeros(len(order)), anchors[order], parents, edges)
    scorer = Scorer(block)
    scores = block.vectors @ rows.T
    low = np.sort(scores, axis=1)[:, -20].astype(float)
    high = np.full(len(order), np.inf)
    seen = {k: set() for k in range(len(order))}
    for place, found, exact in scorer.walk(rows, lambda places: True, low, high):
        assert (exact == scores[place, found]).all()
        seen[place].update(found.tolist())
    for place in seen:
        assert set(np.flatnonzero(scores[place] >= low[place])) <= seen[place]
    assert scorer.rescored < 0.3 * scorer.met


@pytest.mark.parametrize("folder", ["small", "medium"])
def test_query_against_sql(spark, folder, request):
    path = request.getfixturevalue(folder)
    ours = op11_hard_negatives(spark, path)
    theirs = connect(path).sql(ORACLES["op11_hard_negatives"])
    assert ours.columns == theirs.columns and ours.count() > 0
    assert counted(ours.collect()) == counted(theirs.fetchall())


def test_query_moves_labels_and_scales(spark, medium):
    rows = op11_hard_negatives(spark, medium)
    assert rows.where("80 * positive_score > 100 * negative_score or negative_score > positive_score").isEmpty()
    assert rows.agg(F.max("rank")).first()[0] <= hard_negatives.BEST
