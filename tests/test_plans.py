"""Shape of the physical plans."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from parity.catalog import QUERIES
from tallybook.operators.dedup import keep_one
from tallybook.operators.ordered import GROUP_ROWS, PART, Parts, cut_into_parts, scan


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("name", [n for n in QUERIES if "in_parts" not in n])
def test_no_pairing_of_all_rows_and_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert operator not in text


def test_keep_one_drops_copies_ahead_of_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 as key", "id as at", "id as other")
    text = plan(keep_one(df, ["key"], ["at desc"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange") == 1


def test_legs_come_from_one_pass(spark, small):
    assert plan(QUERIES["split_legs"](spark, small)).count("events.parquet") == 2  # trades, candles


def test_fifo_shuffles_by_symbol_once(spark, small):
    text = plan(QUERIES["fifo_match"](spark, small))
    assert text.count("Exchange hashpartitioning(symbol") == 1
    assert text.count("BroadcastHashJoin") == 1


def test_scans_read_the_needed_columns_only(spark, small):
    text = plan(QUERIES["hub_binance_trade"](spark, small))
    assert "ReadSchema: struct<l_suppkey:bigint,l_linestatus:string,l_shipdate:timestamp_ntz>" in text
    assert "ReadSchema: struct<event_id:bigint>" in text


def test_status_filter_reaches_the_scan(spark, tmp_path):
    from tallybook.plans import binance
    from tallybook.sources.schemas import SCHEMAS

    path = str(tmp_path / "orders")
    spark.createDataFrame([], SCHEMAS["binance_orders_spot"]).write.parquet(path)
    text = plan(binance.sat_binance_order(spark.read.parquet(path), "run"))
    assert "EqualTo(status,FILLED)" in text


def test_small_parts_grow_instead_of_becoming_too_many():
    """At 2,000 rows a part, 200 million rows were 50,000 tasks, and millions of sampled rows at the driver."""
    assert Parts.of(216_000_000, 12, 2_000).count == Parts.of(36_000_000, 12, 2_000).count == 256
    assert Parts.of(100_000, 12, 2_000).count == 51
    assert Parts.of(6_000_000_000, 12, GROUP_ROWS).count == Parts.of(6_000_000_000, 12, 2_000).count == 3_001


def test_windows_over_parts_need_no_shuffle(spark):
    df = spark.range(1000).selectExpr("'hot' as key", "id as place")
    order = ["place"]
    parts = Parts(5, 1)
    laid = cut_into_parts(df, ["key"], order, parts)
    summed = scan(laid, ["key"], order, {"ahead": ("place", "bigint")}, parts=parts)
    text = plan(summed)
    assert laid.select(F.spark_partition_id() == F.col(PART)).distinct().collect() == [(True,)]
    # Only the table of parts moves: to be summed up by key, then to everyone.
    assert text.count("Exchange hashpartitioning(key") == text.count("Exchange hashpartitioning") == 1
    assert text.count("BroadcastExchange") == 1
    assert "Exchange rangepartitioning" not in text
