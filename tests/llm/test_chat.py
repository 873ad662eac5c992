from __future__ import annotations

import hashlib
import random
import re
import time

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybook.llm import chat
from tallybook.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import counted

BITS = ["<", "|", "\\", ">", "\n", "é", "🙂", "%", "<|im_end|>", "<|im_start|>assistant\n", "0A"]
NODES = "conv_id bigint, node bigint, parent bigint, role string, text string, score double"


def plain_best(nodes: list[tuple], keep: int) -> set[tuple[int, tuple[int, ...]]]:
    """Best paths by walking up from every leaf."""
    found = set()
    for conv in {x[0] for x in nodes}:
        own = {x[1]: x for x in nodes if x[0] == conv}
        inner = {x[2] for x in own.values()}
        ways = []
        for leaf in own.keys() - inner:
            way, at = [], leaf
            while at in own and at not in way:
                way.append(at)
                at = own[at][2]
            if at in way:
                continue
            ways.append((-sum(own[k][5] or 0 for k in way), leaf, tuple(reversed(way))))
        found |= {(conv, way) for _, _, way in sorted(ways)[:keep]}
    return found


@pytest.mark.parametrize("keep", [1, 3])
def test_random_trees(spark, keep):
    draw = random.Random(keep)
    nodes = []
    for conv in (None, 0, 1, 2):
        for node in range(60):
            parent = draw.choice([None, node - 1, node // 2 - 1, 999]) if node else None
            nodes.append((conv, node, parent, "user", f"t{node}", draw.choice([0.0, 1.0, -2.0, 0.5, None])))
    nodes += [(5, 0, 1, "user", "circle", 1.0), (5, 1, 0, "user", "circle", 1.0), (5, 2, 1, "user", "below", 1.0), (5, 3, None, "user", "alone", 0.0)]
    rows = chat.paths(spark.createDataFrame(nodes, NODES), keep).collect()
    ways: dict = {}
    for r in rows:
        ways.setdefault((r.conv_id, r.leaf), []).append((r.depth, r.node))
    assert all([d for d, _ in sorted(x)] == list(range(len(x))) for x in ways.values())
    assert {(conv, tuple(n for _, n in sorted(x))) for (conv, _), x in ways.items()} == plain_best(nodes, keep)


def test_long_chain(spark):
    nodes = spark.range(300).select(
        F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("node"), F.expr("nullif(id - 1, -1)").alias("parent"),
        F.lit("user").alias("role"), F.col("id").cast("string").alias("text"), F.lit(1.0).alias("score"),
    )
    (row,) = chat.formatted(nodes).collect()
    assert row.n_turns == 300
    assert re.findall(r"\n(\d+)<", row.formatted) == [str(k) for k in range(300)]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.sampled_from(BITS), max_size=12).map("".join), min_size=3, max_size=40))
def test_round_trip(spark, texts):
    """Any texts and roles come back, and the loss spans hold the assistant's texts."""
    roles = [texts[-1 - k] if k % 3 == 0 else ("assistant" if k % 2 else "user") for k in range(len(texts))]
    turns = [(k // 5, k % 5, r, x) for k, (r, x) in enumerate(zip(roles, texts))]
    rows = chat.formatted(chat.threaded(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")))
    rows = rows.select("conv_id", chat.parsed(F.col("formatted")).alias("turns"), chat.loss_text("formatted", "loss_spans").alias("loss"))
    for r in rows.collect():
        own = [x for x in turns if x[0] == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == [(x[2], x[3]) for x in own]
        assert r.loss == "".join(x[3] for x in own if x[2] == "assistant")


def chain(spark, turns: int):
    """One conversation, every other turn the assistant's."""
    return spark.range(turns).select(
        F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("node"), F.expr("nullif(id - 1, -1)").alias("parent"),
        F.expr("if(id % 2 = 0, 'user', 'assistant')").alias("role"),
        F.expr("concat('turn ', id, ' <|im_end|> ', repeat('word ', cast(id % 40 as int)))").alias("text"), F.lit(0.0).alias("score"),
    )


def read_back(spark, turns: int) -> float:
    started = time.perf_counter()
    rows = chat.formatted(chain(spark, turns))
    (row,) = rows.select(chat.loss_text("formatted", "loss_spans").alias("loss")).select(F.length("loss").alias("n"), F.sha2("loss", 256).alias("sha")).collect()
    expected = "".join(f"turn {k} <|im_end|> " + "word " * (k % 40) for k in range(1, turns, 2))
    assert (row.n, row.sha) == (len(expected), hashlib.sha256(expected.encode()).hexdigest())
    return time.perf_counter() - started


def test_time_grows_with_the_conversation(spark):
    read_back(spark, 2_000)
    short, long = read_back(spark, 20_000), read_back(spark, 80_000)
    assert long < 4 * short + 5 and long < 60


def test_spans_are_checked(spark):
    rows = chat.formatted(chain(spark, 6))
    for change in ("start + 1", "start"):
        length = "length" if change != "start" else "length - 1"
        moved = rows.withColumn("loss_spans", F.expr(f"transform(loss_spans, s -> struct({change.replace('start', 's.start')} as start, {length.replace('length', 's.length')} as length))"))
        with pytest.raises(Exception, match="not the text of a turn"):
            moved.select(chat.loss_text("formatted", "loss_spans")).collect()


def test_edge_cases(spark):
    turns = [(1, 0, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, None, "assistant", "x" * 10**6), (2, 1, "user", "")]
    frame = spark.createDataFrame([(*x, 9, 1.0, 2) for x in turns], "conv_id bigint, turn bigint, role string, text string, node int, score double, parent int")
    rows = {r.conv_id: r for r in chat.formatted(chat.threaded(frame)).collect()}
    assert rows[1].formatted == "<|im_start|>\n<|im_end|>\n" + 2 * "<|im_start|>user\na<|im_end|>\n"
    losses = chat.formatted(chat.threaded(frame)).select("conv_id", chat.loss_text("formatted", "loss_spans").alias("loss"))
    assert {r.conv_id: len(r.loss) for r in losses.collect()} == {1: 0, None: 10**6, 2: 0}
    assert rows[None].n_turns == 1 and len(rows[None].formatted) == 10**6 + 33 and rows[2].loss_spans == []
    assert chat.formatted(chat.threaded(frame.limit(0))).count() == 0


def test_query_against_sql(spark, small):
    rows = QUERIES["op9_chat"](spark, small)
    db = duckdb.connect()
    db.sql(f"create view conversations as select * from '{small}/conversations.parquet'")
    expected = db.sql(f"select {', '.join(rows.columns)} from ({ORACLES['op9_chat']})").fetchall()
    assert counted(rows.collect()) == counted(expected)
    assert not re.search("Python|Arrow|Cartesian|NestedLoop", rows._jdf.queryExecution().toString())
