from __future__ import annotations

import random
from collections import Counter, deque
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.operators import checks, rates
from tallybook.operators.balance import running_balance
from tallybook.operators.dedup import keep_one
from tallybook.operators.fifo import fifo_lots, fifo_profit
from tallybook.operators.numbering import number_occurrences, occurrences
from tallybook.operators.ordered import Parts, cut_into_parts, parts_needed, scan
from tallybook.operators.position import position_before, signed_quantity, split_legs
from tallybook.plans.business import calc_bybit_pnl_per_trade

D = Decimal
TRADES = "fk_bybit_trade string, symbol string, trade_at int, price decimal(18,8), price_eur decimal(28,12), quantity decimal(18,4)"


def trades(spark, rows):
    """Rows of (key, symbol, time, signed quantity, price)."""
    return spark.createDataFrame([(k, s, t, D(p), D(p) / 2, D(q)) for k, s, t, q, p in rows], TRADES)


def by_queue(rows):
    """First in, first out, the plain way."""
    books, found = {}, {}
    for key, symbol, _, q, price in sorted(rows, key=lambda r: (r[2], r[0])):
        lots = books.setdefault(symbol, deque())
        profit, left = D(0), D(q)
        while left and lots and (lots[0][0] > 0) != (left > 0):
            part = min(abs(left), abs(lots[0][0]))
            side = 1 if lots[0][0] > 0 else -1
            profit += side * (D(price) - lots[0][1]) * part
            lots[0][0] -= side * part
            left += side * part
            if not lots[0][0]:
                lots.popleft()
        if left:
            lots.append([left, D(price)])
        found[key] = profit
    return found


def realised(df):
    return {r.fk_bybit_trade: (r.realized_pnl, r.realized_pnl_eur) for r in df.collect()}


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([("a", "X", 1, 3, 10), ("b", "X", 2, 2, 12), ("c", "X", 3, -4, 15)], {"a": 0, "b": 0, "c": 18}),
        ([("a", "X", 1, 2, 10), ("b", "X", 2, -5, 11), ("c", "X", 3, 3, 9)], {"a": 0, "b": 2, "c": 6}),
        ([("a", "X", 1, 0, 10), ("b", "X", 2, 1, 10), ("c", "X", 3, -1, 7)], {"a": 0, "b": 0, "c": -3}),
        # In one second the key decides: b buys before c sells.
        ([("c", "X", 1, -1, 20), ("b", "X", 1, 1, 10)], {"b": 0, "c": 10}),
        # Symbols do not close each other.
        ([("a", "X", 1, 1, 10), ("b", "Y", 2, -1, 11)], {"a": 0, "b": 0}),
    ],
)
def test_fifo_by_hand(spark, rows, expected):
    found = realised(fifo_profit(trades(spark, rows)))
    assert found == {k: (D(v), D(v) / 2) for k, v in expected.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_fifo_matches_a_queue_with_and_without_parts(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        # One symbol holds most trades; few seconds, so the key often decides.
        symbol = rng.choices(["HOT", "A", "B"], [8, 1, 1])[0]
        quantity = D(rng.choice([-1, 1]) * rng.choice([0, 1, 2, 7, 250])) / rng.choice([1, 10, 10000])
        rows.append((f"k{rng.randrange(10**9)}-{i}", symbol, rng.randrange(100), quantity, D(rng.randrange(1, 99)) / 8))
    expected = {k: (v, v / 2) for k, v in by_queue(rows).items()}
    df = trades(spark, rows).repartition(3)
    assert realised(fifo_profit(df)) == expected
    assert realised(fifo_profit(df, group_rows=40)) == expected


def test_one_huge_lot_serves_closes_in_many_parts(spark):
    rows = [("k0000", "X", 0, 500, 10)] + [(f"k{i:04d}", "X", i, -1, 11) for i in range(1, 501)]
    found = realised(fifo_profit(trades(spark, rows), group_rows=30))
    assert Counter(found.values()) == {(D(1), D("0.5")): 500, (D(0), D(0)): 1}


def test_trades_without_symbol_close_nothing(spark):
    rows = [("a", None, 1, 2, 10), ("b", None, 2, -2, 12), ("c", "X", 1, 1, 10), ("d", "X", 2, -1, 12)] * 1
    for group_rows in (100, 1):
        found = realised(fifo_profit(trades(spark, rows), group_rows=group_rows))
        assert found == {"a": (0, 0), "b": (0, 0), "c": (0, 0), "d": (2, 1)}


def by_queue_in_pairs(rows):
    """(close, lot, units) of each pair, first in, first out."""
    books, found = {}, Counter()
    for key, symbol, _, q, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        lots, left = books.setdefault(symbol, deque()), D(q)
        while left and lots and (lots[0][1] > 0) != (left > 0):
            part = min(abs(left), abs(lots[0][1]))
            side = 1 if lots[0][1] > 0 else -1
            found[key, lots[0][0], part] += 1
            lots[0][1] -= side * part
            left += side * part
            if not lots[0][1]:
                lots.popleft()
        if left:
            lots.append([key, left])
    return found


@pytest.mark.parametrize("seed", [3, 4])
def test_lots_match_a_queue_with_and_without_parts(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(500):
        symbol = rng.choices(["HOT", "A"], [9, 1])[0]
        quantity = D(rng.choice([-1, 1]) * rng.choice([0, 1, 2, 7, 400])) / rng.choice([1, 10, 10000])
        rows.append((f"k{rng.randrange(10**9)}-{i}", symbol, rng.randrange(80), quantity, D(rng.randrange(1, 99)) / 8))
    df = trades(spark, rows).repartition(3)
    profits = {k: v for k, v in realised(fifo_profit(df)).items() if v != (0, 0)}
    for group_rows in (1000, 40):
        lots = fifo_lots(df, group_rows=group_rows).collect()
        assert Counter((r.closed_by, r.opened_by, r.units) for r in lots) == by_queue_in_pairs(rows)
        assert len(lots) <= 2 * len(rows)
        summed = {}
        for r in lots:
            a, b = summed.get(r.closed_by, (0, 0))
            summed[r.closed_by] = a + r.realized_pnl, b + r.realized_pnl_eur
        assert {k: v for k, v in summed.items() if v != (0, 0)} == profits


def test_lots_of_a_flip_of_one_huge_lot_and_without_symbol(spark):
    rows = [("k0000", "X", 0, 300, 10)] + [(f"k{i:04d}", "X", i, -1, 11) for i in range(1, 300)]
    rows += [("k0300", "X", 300, -4, 12), ("k0301", "X", 301, 1, 9), ("n0", None, 1, 2, 10), ("n1", None, 2, -2, 10)]
    for group_rows in (1000, 30):
        lots = {(r.book, r.closed_by, r.opened_by): r for r in fifo_lots(trades(spark, rows), group_rows=group_rows).collect()}
        assert len(lots) == 301 and not any(r.symbol is None for r in lots.values())
        assert all(r.units == 1 and r.realized_pnl == r.close_price - 10 for (book, *_), r in lots.items() if book == "long")
        short = lots["short", "k0301", "k0300"]
        assert (short.units, short.realized_pnl, short.realized_pnl_eur) == (1, 3, D("1.5"))
        assert (short.opened_at, short.closed_at) == (300, 301)


def test_position_and_legs(spark):
    rows = [("a", "X", 1, 2, 10), ("b", "X", 2, -5, 11), ("c", "X", 3, 0, 9), ("d", "X", 4, 3, 9)]
    positioned = position_before(trades(spark, rows), ["symbol"], ["trade_at", "fk_bybit_trade"])
    assert {r.fk_bybit_trade: r.held_before for r in positioned.collect()} == {"a": 0, "b": 2, "c": -3, "d": -3}
    legs = split_legs(positioned, ["fk_bybit_trade"])
    assert {tuple(r) for r in legs.collect()} == {
        ("a", "long_open", D(2)),
        ("b", "long_close", D(2)),
        ("b", "short_open", D(3)),
        ("d", "short_close", D(3)),
    }


def test_signed_quantity(spark):
    rows = [("Buy", "Trade"), ("Sell", "Trade"), ("Buy", "Funding"), ("None", "Trade"), ("Buy", None)]
    df = spark.createDataFrame(rows, "side string, execution_type string").withColumn("quantity", F.lit(2))
    assert [r.q for r in df.selectExpr(f"{signed_quantity()} as q").collect()] == [2, -2, 0, 0, 0]


def test_quantities_balance_over_each_symbol(spark, small):
    from parity.catalog import QUERIES

    legs = QUERIES["split_legs"](spark, small).groupBy("symbol").pivot("leg").sum("units")
    final = QUERIES["signed_position"](spark, small).groupBy("symbol").agg(F.sum("quantity").alias("net"))
    for r in legs.na.fill(0).join(final, "symbol").collect():
        assert (r.long_open - r.long_close) - (r.short_open - r.short_close) == r.net
        assert r.long_close <= r.long_open and r.short_close <= r.short_open


def test_missing_candle_drops_the_trade_before_positions(spark):
    sat = spark.createDataFrame(
        [("a", "X", "2024-01-01 00:00:10", "Buy", "10"), ("b", "X", "2024-01-01 00:01:10", "Sell", "11")],
        "fk_bybit_trade string, symbol string, trade_at string, side string, price string",
    ).selectExpr(
        "fk_bybit_trade",
        "symbol",
        "cast(trade_at as timestamp) as trade_at",
        "side",
        "'Trade' as execution_type",
        "cast(price as decimal(18,8)) as price",
        "cast(1 as decimal(18,4)) as quantity",
        "cast(0.1234 as decimal(18,4)) as fee_amount",
    )
    klines = spark.createDataFrame([("2024-01-01 00:01:00",)], "at string").selectExpr(
        "'USDTEUR' as symbol",
        "'1m' as kline_interval",
        "cast(at as timestamp) as kline_start_at",
        "cast(0.90019999 as decimal(18,8)) as close_price",
    )
    for candles, grid_bytes in ((klines, None), (klines.hint("merge"), None), (klines, rates.GRID_BYTES)):
        rows = calc_bybit_pnl_per_trade(sat, candles, grid_bytes=grid_bytes).collect()
        assert [(r.fk_bybit_trade, r.quantity, r.realized_pnl) for r in rows] == [("b", D(-1), D(0))]
        assert rows[0].price_eur == D("9.9011") and rows[0].fee_amount_eur == D("0.11107234")


def candles_of(spark, minutes):
    """A rate a minute (from 2024-01-01 on), and rows in minutes with and without one."""
    rates = spark.createDataFrame([(m, str(1 + m / 10_000)) for m in minutes], "m bigint, x string").selectExpr(
        "timestamp '2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(m as int)) as _rate_at", "cast(x as decimal(9,4)) as fx_rate"
    )
    rows = spark.range(0, 4400, 7).selectExpr(
        "id", "timestamp '2023-12-31 22:00:00' + make_dt_interval(0, 0, cast(id as int), id % 60 + 0.5) as at"
    )
    return rates, rows.unionByName(spark.sql("select -1L as id, cast(null as timestamp) as at"))


def test_rates_from_a_grid_are_those_of_the_join(spark):
    from tests.test_plans import plan

    odd, rows = candles_of(spark, [m for m in range(3000) if m % 13 and not 700 < m < 900])
    off_grid = odd.unionByName(spark.sql("select timestamp '2024-01-01 00:13:30' as _rate_at, cast(9 as decimal(9,4)) as fx_rate"))
    grid = rates.minute_grid(off_grid)
    assert grid.selectExpr("size(_rates) as n").distinct().collect() == [(1440,)]
    joined = Counter(map(tuple, rates.fx_at_minute(rows, off_grid, "at").collect()))
    looked_up = rates.fx_from_grid(rows, grid, "at")
    assert Counter(map(tuple, looked_up.collect())) == joined and 0 < sum(joined.values()) < rows.count()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(rates.rated(rows, off_grid, "at", rates.GRID_BYTES))
        assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
        assert "SortMergeJoin" in plan(rates.rated(rows, off_grid, "at"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_no_grid_beyond_its_bytes_or_with_two_rates_a_minute(spark):
    odd, rows = candles_of(spark, range(0, 4000, 3))
    a_day = rates.DAY_MINUTES * rates.RATE_BYTES
    assert rates.minute_grid(odd, 2 * a_day) is None and rates.minute_grid(odd, 3 * a_day) is not None
    twice = odd.unionByName(odd.limit(5).selectExpr("_rate_at", "cast(7 as decimal(9,4)) as fx_rate"))
    assert rates.minute_grid(twice) is None
    expected = Counter(map(tuple, rates.fx_at_minute(rows, twice, "at").collect()))
    assert Counter(map(tuple, rates.rated(rows, twice, "at", rates.GRID_BYTES).collect())) == expected
    empty = rates.minute_grid(odd.limit(0))
    assert empty is not None and rates.fx_from_grid(rows, empty, "at").count() == 0


def test_balance_ties_share_one_total(spark):
    rows = [("w", "c", 1, "5"), ("w", "c", 1, "5"), ("w", "c", 1, "7"), ("w", "c", 0, "-1"), ("w", None, 1, "2")]
    df = spark.createDataFrame(rows, "wallet string, coin string, at int, x string")
    df = df.withColumn("change", F.col("x").cast("decimal(18,8)"))
    expected = Counter({("c", 1, D(5), D(16)): 2, ("c", 1, D(7), D(6)): 1, ("c", 0, D(-1), D(-1)): 1, (None, 1, D(2), D(2)): 1})
    for group_rows in (100, 2):
        found = running_balance(df, ["wallet", "coin"], "at", "change", group_rows=group_rows)
        assert Counter((r.coin, r["at"], r.change, r.accountbalance) for r in found.collect()) == expected


def test_balance_of_unknown_amounts_only_is_unknown(spark):
    rows = [("w", 1, None), ("w", 2, "3"), ("w", 3, None), ("v", 1, None)]
    df = spark.createDataFrame(rows, "wallet string, at int, x string").withColumn("change", F.expr("cast(x as decimal(18,8))"))
    for group_rows in (100, 2):
        found = running_balance(df, ["wallet"], "at", "change", group_rows=group_rows)
        assert {(r.wallet, r["at"]): r.accountbalance for r in found.collect()} == {
            ("w", 1): None,
            ("w", 2): D(3),
            ("w", 3): D(3),
            ("v", 1): None,
        }


@pytest.mark.parametrize("group_rows", [7, 50, 400])
def test_balance_in_parts_equals_the_window(spark, group_rows):
    """Peers that go on over several parts, copies of a row, NULL times and amounts, a NULL account."""
    df = spark.range(1200).selectExpr(
        "if(id % 3 = 0, null, concat('w', id % 2)) as wallet",
        "if(id % 17 = 0, null, cast(if(id % 4 < 2, 5, id % 40) as int)) as at",
        "if(id % 13 = 0, null, cast(if(id % 4 = 0, 7, id % 3 - 1) as decimal(18,8))) as change",
        "if(id % 2 = 0, 'copy', cast(id as string)) as note",
    )
    expected = Counter(map(tuple, running_balance(df, ["wallet"], "at", "change").collect()))
    found = running_balance(df, ["wallet"], "at", "change", group_rows=group_rows)
    assert found.columns == [*df.columns, "accountbalance"]
    assert Counter(map(tuple, found.collect())) == expected


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("group_rows, written", [(400, 0), (20, 1)])
def test_balance_by_the_calendar_equals_the_window_and_moves_rows_once(spark, tmp_path, kind, group_rows, written):
    """Copies, peers, NULL times, amounts and accounts, an account of unknown amounts; in days, and in hours that are many."""
    path = str(tmp_path / "rows")
    spark.range(6000).selectExpr(
        "case when id < 300 then null when id % 500 = 1 then 'unknown' else 'w' end as wallet",
        f"if(id % 301 = 0, null, cast(timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id div 2 * 480) as {kind})) as at",
        "if(id % 13 = 0 or id % 500 = 1, null, cast(id % 3 - 1 as decimal(18,8))) as change",
        "if(id % 2 = 0, 'copy', cast(id as string)) as note",
    ).write.parquet(path)
    df = spark.read.parquet(path)
    expected = Counter(map(tuple, running_balance(df, ["wallet"], "at", "change").collect()))
    plans, text = written_plans(df, lambda d: running_balance(d, ["wallet"], "at", "change", group_rows=group_rows))
    found = running_balance(df, ["wallet"], "at", "change", group_rows=group_rows)
    assert found.columns == [*df.columns, "accountbalance"]
    assert Counter(map(tuple, found.collect())) == expected
    # Only sums of spans are written on the way, if these are many; rows move once.
    assert len(plans) == written and all("note" not in p for p in plans)
    assert text.count("FileScan parquet") == 2 - written and text.count("REPARTITION_BY_COL") == 1


def test_spans_grow_as_small_parts_do(spark, tmp_path):
    """A minute holds 12 rows, more than the 5 asked for, but parts of 5 rows would be 1,201 and hold 24 instead."""
    path = str(tmp_path / "rows")
    spark.range(6000).selectExpr(
        "concat('w', id % 2) as wallet",
        "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, id div 24, id % 24) as at",
        "cast(id % 7 - 3 as decimal(18,8)) as change",
        "id as note",
    ).write.parquet(path)
    df = spark.read.parquet(path)
    expected = Counter(map(tuple, running_balance(df, ["wallet"], "at", "change").collect()))
    plans, text = written_plans(df, lambda d: running_balance(d, ["wallet"], "at", "change", group_rows=5))
    assert all("note" not in p for p in plans) and text.count("REPARTITION_BY_COL") == 1
    assert Counter(map(tuple, running_balance(df, ["wallet"], "at", "change", group_rows=5).collect())) == expected


def test_balance_of_few_rows_takes_few_tasks_however_many_rows_they_sum_up(spark, monkeypatch):
    """Net changes of an hour each; the sizes come from 600 times as many rows, which asked for 600 parts."""
    rows = spark.range(720_000).selectExpr("'w' as wallet", "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id div 600 * 60) as at")
    net = rows.groupBy("wallet", "at").agg(F.count("*").cast("decimal(18,8)").alias("change"))
    cut = []
    monkeypatch.setattr("tallybook.operators.balance.cut_into_parts", lambda *a: cut.append(a))
    found = running_balance(net, ["wallet"], "at", "change", group_rows=1_200, sizes_from=rows)
    assert not cut and found.agg(F.max("accountbalance"), F.count("*")).first()[:] == (D(720_000), 1200)


def test_balance_of_one_moment_cut_into_parts(spark):
    """All rows are peers: each has the total, whichever part it is in."""
    df = spark.range(500).selectExpr("'w' as wallet", "1 as at", "cast(2 as decimal(18,8)) as change", "id as note")
    found = running_balance(df, ["wallet"], "at", "change", group_rows=20).collect()
    assert len(found) == 500 and {r.accountbalance for r in found} == {D(1000)}


@pytest.mark.parametrize("kind", ["int", "string", "date", "timestamp", "timestamp_ntz", "decimal(20,9)"])
def test_balance_in_parts_moves_rows_once_and_deals_moments_of_many_rows(spark, kind):
    """Half of the rows share time and amount, a fifth are copies of one row; NULL times, amounts and accounts."""
    at = {
        "string": "concat('\"é', place)",
        "date": "date'2024-03-30' + place",
        "timestamp": "timestamp'2024-03-31 01:59:59.123456' + make_dt_interval(0, 0, 0, place / 1000)",
        "timestamp_ntz": "cast(timestamp'2024-10-27 01:59:59.123456' + make_dt_interval(0, 0, 0, place / 1000) as timestamp_ntz)",
    }.get(kind, f"cast(place as {kind})")
    df = spark.range(8000, numPartitions=8).selectExpr("id", "cast(if(id % 2 = 0, 7, id % 50) as int) as place").selectExpr(
        "if(id % 9 = 1, null, 'w') as wallet",
        f"if(id % 17 = 1, null, {at}) as at",
        "if(id % 13 = 1, null, cast(if(id % 2 = 0, 3, id % 5 - 2) as decimal(18,8))) as change",
        "if(id % 10 < 3, 0, id) as note",
    )
    order = ["at", "change desc"]
    plans = written_plans(df, lambda d: cut_into_parts(d, ["wallet"], order, Parts(20, 2), unique=False))[0]
    assert [p.count("Exchange") for p in plans] == [1]
    laid = cut_into_parts(df, ["wallet"], order, Parts(20, 2), unique=False)
    place = "struct(wallet is null, wallet, at is null, at, change is null, -change)"
    sizes = laid.groupBy("_part").agg(F.count("*").alias("n"), F.expr(f"min({place})").alias("lo"), F.expr(f"max({place})").alias("hi"))
    assert sizes.agg(F.sum("n")).first()[0] == 8000 and sizes.agg(F.max("n")).first()[0] < 3 * 400
    assert sizes.selectExpr("hi > lead(lo) over (order by _part) as mixed").filter("mixed").isEmpty()

    expected = Counter(map(tuple, running_balance(df, ["wallet"], "at", "change").collect()))
    plans, _ = written_plans(df, lambda d: running_balance(d, ["wallet"], "at", "change", group_rows=400))
    assert len(plans) == 1 and "note" in plans[0] and plans[0].count("Exchange") == 1
    assert Counter(map(tuple, running_balance(df, ["wallet"], "at", "change", group_rows=400).collect())) == expected


def test_balance_in_parts_reads_its_input_twice_and_joins_no_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = spark.range(300).selectExpr("id", "concat('w', id % 2) as wallet", "id % 9 as at", "cast(id as decimal(18,8)) as change")
    rows.write.parquet(path)
    plans, text = written_plans(spark.read.parquet(path), lambda d: running_balance(d, ["wallet"], "at", "change", group_rows=20))
    # Once for the sizes of the accounts, once for the rows; then they are read where they were written.
    assert [p.count("FileScan parquet") for p in plans] == [1]
    assert "FileScan" not in text and "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 1


def skewed(spark, n=2000):
    """A third of the rows are copies of one row, another third shares its key."""
    return spark.range(n).selectExpr(
        "case when id % 3 < 2 then 'hot' else concat('k', id % 50) end as key",
        "case when id % 3 = 0 then 'same' else cast(id as string) end as amount",
    )


def test_numbering_survives_a_hot_key_and_many_copies(spark):
    df = skewed(spark)
    plain = Counter(tuple(r) for r in number_occurrences(df, ["key"], ["amount"]).collect())
    parts = Counter(tuple(r) for r in number_occurrences(df, ["key"], ["amount"], group_rows=100).collect())
    assert plain == parts
    assert sum(plain.values()) == df.count()


def written_plans(df, build):
    """The plans that were written out on the way, and the plan of the result."""
    from tests.test_plans import plan

    plans, kind = [], type(df)
    original = kind.checkpoint
    try:
        kind.checkpoint = lambda rows, *a: plans.append(plan(rows)) or original(rows, *a)
        return plans, plan(build(df))
    finally:
        kind.checkpoint = original


def test_numbering_reads_rows_once_besides_the_sizes(spark, tmp_path):
    """Cold keys are read apart, and only if there are any."""
    reads = {}
    for name, df in (("mixed", skewed(spark)), ("hot", skewed(spark).withColumn("key", F.lit("k")))):
        df.write.parquet(str(tmp_path / name))
        rows = spark.read.parquet(str(tmp_path / name))
        plans, text = written_plans(rows, lambda d: number_occurrences(d, ["key"], ["amount"], group_rows=100))
        reads[name] = [p.count("FileScan parquet") for p in [*plans, text]]
        found = Counter(map(tuple, number_occurrences(rows, ["key"], ["amount"], group_rows=100).collect()))
        assert found == Counter(map(tuple, number_occurrences(rows, ["key"], ["amount"]).collect()))
    assert reads == {"mixed": [1, 1, 1], "hot": [1, 1, 0]}


def test_the_ledger_is_written_once_in_either_order(spark):
    rows = [(f"k{i:03d}", "X", i, (-1) ** (i % 3) * (i % 5), 10 + i % 7) for i in range(200)]
    for build in (fifo_profit, fifo_lots):
        plans, _ = written_plans(trades(spark, rows), lambda d: build(d, group_rows=30))
        assert len(plans) == 2 and all(p.count("Exchange rangepartitioning") == 1 for p in plans)


def test_numbering_treats_null_as_a_key(spark):
    rows = [(None, "1"), (None, "2"), ("a", "1")] * 4
    df = spark.createDataFrame(rows, "key string, amount string")
    for group_rows in (100, 5):
        found = number_occurrences(df, ["key"], ["amount"], group_rows=group_rows).collect()
        assert sorted(r.r for r in found if r.key is None) == list(range(1, 9))
        assert sorted(r.r for r in found if r.key == "a") == list(range(1, 5))


@pytest.mark.parametrize("chunk_rows", [7, 100_000])
def test_occurrences_equal_the_ranked_keys(spark, chunk_rows):
    df = skewed(spark)
    counted = occurrences(df, ["key"], chunk_rows=chunk_rows)
    ranked = number_occurrences(df, ["key"], ["amount"]).select("key", "r")
    assert Counter(map(tuple, counted.collect())) == Counter(map(tuple, ranked.collect()))


def test_occurrences_of_few_keys_are_spread_over_tasks(spark):
    """Five keys with a thousand rows each are five counts, which one task would unfold."""
    df = spark.range(5000).selectExpr("if(id % 5 = 0, null, id % 5) as key")
    counted = occurrences(df, ["key"], chunk_rows=50, task_rows=500)
    found = counted.withColumn("_task", F.spark_partition_id()).collect()
    assert Counter((r.key, r.r) for r in found) == Counter((k, r) for k in (None, 1, 2, 3, 4) for r in range(1, 1001))
    sizes = Counter(r._task for r in found)
    assert len(sizes) >= 8 and max(sizes.values()) <= 1500


def test_keep_one_is_total(spark):
    rows = [("a", 1, "x"), ("a", 1, "w"), ("a", 0, "v"), (None, 1, "u"), (None, 2, "t")]
    df = spark.createDataFrame(rows, "key string, at int, other string")
    kept = keep_one(df, ["key"], ["at desc"])
    assert {tuple(r) for r in kept.collect()} == {("a", 1, "w"), (None, 2, "t")}


def test_parts_are_consecutive_and_balanced(spark):
    df = spark.range(5000).selectExpr("if(id % 10 < 9, 'hot', 'cold') as key", "id * 7919 % 5000 as place")
    parts = parts_needed(df, ["key"], 500)
    assert parts.keys == 2 and parts_needed(df, ["key"], 5000) is None
    laid = cut_into_parts(df, ["key"], ["place"], parts)
    sizes = laid.groupBy("_part").agg(F.count("*").alias("n"), F.min("place").alias("lo"), F.max("place").alias("hi"))
    found = sizes.filter("_part > 0").orderBy("_part").collect()
    assert max(r.n for r in found) < 3 * 500
    by_key = laid.groupBy("key", "_part").agg(F.min("place").alias("lo"), F.max("place").alias("hi"))
    for key in ("hot", "cold"):
        ranges = [(r.lo, r.hi) for r in by_key.filter(F.col("key") == key).orderBy("_part").collect()]
        assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))

    sums, seen = {"ahead": ("place", "bigint")}, {"rare": "if(place % 1000 = 3, place, null)"}
    coming = {"next_rare": "if(place % 1000 = 3, place, null)"}
    columns = ["key", "place", "ahead", "rare", "next_rare"]
    split = scan(laid, ["key"], ["place"], sums, seen, parts, coming).select(*columns)
    whole = scan(df, ["key"], ["place"], sums, seen, coming=coming).select(*columns)
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, whole.collect()))
    marks = sorted(r.place for r in df.collect() if r.key == "hot" and r.place % 1000 == 3)
    for r in split.filter("key = 'hot'").collect():
        assert r.next_rare == min((m for m in marks if m > r.place), default=None)


def test_checks(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "key string")
    assert checks.check_not_null(df, "key").count() == 2
    assert [tuple(r) for r in checks.check_unique(df, "key").collect()] == [("a", 2)]
    report = checks.key_report({"t": (df, "key"), "u": (df.filter("key = 'b'"), "key")})
    assert {tuple(r) for r in report.collect()} == {
        ("t", "key", "not_null", 2),
        ("t", "key", "unique", 1),
        ("u", "key", "not_null", 0),
        ("u", "key", "unique", 0),
    }
