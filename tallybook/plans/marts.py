"""Fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.keys import with_audit


def fact_binance_transaction(transactions: DataFrame, balances: DataFrame, run_id: str) -> DataFrame:
    """Transactions with the balance behind them."""
    described = transactions.select(
        "fk_binance_transaction",
        "change_amount",
        F.lit("binance").alias("platform"),
        "coin",
        "transaction_at",
        "operation",
        "wallet",
    )
    joined = described.join(
        balances.select("fk_binance_transaction", "accountbalance"), "fk_binance_transaction", "inner"
    )
    ordered = joined.select(
        "fk_binance_transaction",
        "change_amount",
        "accountbalance",
        "platform",
        "coin",
        "transaction_at",
        "operation",
        "wallet",
    )
    return with_audit(ordered, run_id)


def fact_bybit_trade(profits: DataFrame, run_id: str) -> DataFrame:
    """Trades with their profit."""
    return with_audit(
        profits.select(
            "fk_bybit_trade",
            "quantity",
            "price",
            "price_eur",
            "fee_amount",
            "fee_amount_eur",
            "realized_pnl",
            "realized_pnl_eur",
            F.lit("bybit").alias("platform"),
            "symbol",
            "trade_at",
            "side",
            "execution_type",
        ),
        run_id,
    )
