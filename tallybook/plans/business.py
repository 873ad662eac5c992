"""Balances and profit computed from the raw vault."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.keys import with_audit
from tallybook.operators.balance import running_balance
from tallybook.operators.fifo import fifo_profit
from tallybook.operators.ordered import GROUP_ROWS
from tallybook.operators.position import signed_quantity
from tallybook.operators.rates import divided, multiplied, rated, rates_by_minute

ACCOUNT = ["wallet", "coin"]


def calc_binance_accountbalance(transactions: DataFrame, run_id: str, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Net change and balance per time, wallet and coin."""
    net = transactions.groupBy("transaction_at", *ACCOUNT).agg(
        F.sum("change_amount").cast("decimal(38,8)").alias("change_amount")
    )
    balances = running_balance(
        net, ACCOUNT, "transaction_at", "change_amount", group_rows=group_rows, sizes_from=transactions
    )
    return with_audit(balances, run_id, after=0)


def calc_binance_transaction_accountbalance(
    transactions: DataFrame, run_id: str, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Balance behind each transaction."""
    used = transactions.select("fk_binance_transaction", *ACCOUNT, "transaction_at", "change_amount")
    balances = running_balance(used, ACCOUNT, "transaction_at", "change_amount", group_rows=group_rows)
    return with_audit(balances.select("fk_binance_transaction", "accountbalance"), run_id)


def bybit_base(trades: DataFrame, klines: DataFrame, grid_bytes: int | None = None) -> DataFrame:
    """Trades with signed quantity and with price and fee in EUR."""
    candles = klines.filter("symbol = 'USDTEUR' and kline_interval = '1m'")
    priced = rated(trades, rates_by_minute(candles, "kline_start_at"), "trade_at", grid_bytes)
    return priced.selectExpr(
        "fk_bybit_trade",
        "symbol",
        "trade_at",
        "side",
        "execution_type",
        "price",
        f"cast({multiplied('price')} as decimal(28,12)) as price_eur",
        f"{signed_quantity()} as quantity",
        "fee_amount",
        f"cast({multiplied('fee_amount')} as decimal(28,8)) as fee_amount_eur",
    )


def calc_bybit_pnl_per_trade(
    trades: DataFrame,
    klines: DataFrame,
    group_rows: int = GROUP_ROWS,
    sizes_from: DataFrame | None = None,
    grid_bytes: int | None = None,
) -> DataFrame:
    """Realised profit per trade in USDT and EUR; fees are not subtracted.

    With ``grid_bytes`` rates are looked up in a grid of the candles' minutes, if it is no larger.
    """
    base = bybit_base(trades, klines, grid_bytes)
    return fifo_profit(base, group_rows=group_rows, sizes_from=trades if sizes_from is None else sizes_from)


def calc_kraken_pnl_per_trade(
    positions: DataFrame, ohlc: DataFrame, grid_bytes: int | None = None
) -> DataFrame:
    """Profit as reported by the exchange, converted at the closing minute."""
    candles = ohlc.filter("symbol = 'PF_EURUSD'")
    priced = rated(positions, rates_by_minute(candles, "ohlc_at"), "fill_at", grid_bytes)
    fee = "cast(coalesce(fee, 0) - coalesce(realized_funding, 0) as decimal(18,8))"
    profit = "cast(coalesce(realized_pnl, 0) as decimal(18,8))"
    # The names of update reasons.
    reasons = "when 'fundingRealisation' then 'Funding' when 'trade' then 'Trade' else update_reason"
    moved = "when 1 then 'Buy' when -1 then 'Sell' else 'Funding'"
    return priced.selectExpr(
        "fk_kraken_position as fk_kraken_trade",
        "contract as symbol",
        "fill_at as trade_at",
        f"case sign(new_position - old_position) {moved} end as side",
        f"case update_reason {reasons} end as execution_type",
        "execution_price as price",
        f"{divided('execution_price')} as price_eur",
        "execution_size as quantity",
        f"{fee} as fee_amount",
        f"{divided(fee)} as fee_amount_eur",
        f"{profit} as realized_pnl",
        f"{divided(profit)} as realized_pnl_eur",
    )
