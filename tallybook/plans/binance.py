"""Raw vault of the Binance exports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybook.functions.decimals import from_text, money
from tallybook.functions.keys import key_text
from tallybook.functions.text import amount_text, coin_text, snake
from tallybook.functions.times import epoch_seconds, second
from tallybook.operators.numbering import number_occurrences, occurrences
from tallybook.operators.ordered import GROUP_ROWS
from tallybook.plans.vault import hub, satellite

# Natural keys of records that come without an id.
ORDER_KEY = ["side", "order_utc_at", "pair", "type"]
TRADE_KEY = ["side", "trade_utc_at", "pair"]
TRANSACTION_KEY = ["account", "coin", "operation", "transaction_utc_at"]

# Key texts; ``r`` is the occurrence number within the natural key.
ORDER_TEXT = key_text("'binance'", "lower(side)", epoch_seconds("order_utc_at"), "lower(pair)", "lower(type)", "r")
SPOT_TRADE_TEXT = key_text("'binance'", "lower(side)", epoch_seconds("trade_utc_at"), "lower(pair)", "r")
FUTURES_TRADE_TEXT = key_text("trade_id", "r")
SPOT_TRANSACTION_TEXT = key_text(
    "'binance'", snake("account"), "lower(coin)", snake("operation"), epoch_seconds("transaction_utc_at"), "r"
)
FUTURES_TRANSACTION_TEXT = key_text("transaction_id", "r")
PAYIN_TEXT = key_text("'binance'", "order_id")

FILLED = "status = 'FILLED'"
SUCCESSFUL = "status = 'Successful'"
SPOT, FUTURES = "'Spot'", "'USD-M Futures'"


def _amount(column: str) -> str:
    return money(amount_text(column))


def hub_binance_order(orders_spot: DataFrame, run_id: str) -> DataFrame:
    numbered = occurrences(orders_spot.filter(FILLED), ORDER_KEY)
    return hub(numbered, ORDER_TEXT, "pk_binance_order", "bk_binance_order", run_id)


def hub_binance_payin(payins: DataFrame, run_id: str) -> DataFrame:
    return hub(payins.filter(SUCCESSFUL), PAYIN_TEXT, "pk_binance_payin", "bk_binance_payin", run_id)


def hub_binance_trade(trades_spot: DataFrame, trades_futures: DataFrame, run_id: str) -> DataFrame:
    spot = occurrences(trades_spot, TRADE_KEY).selectExpr(f"{SPOT_TRADE_TEXT} as text")
    futures = occurrences(trades_futures, ["trade_id"]).selectExpr(f"{FUTURES_TRADE_TEXT} as text")
    return hub(spot.unionByName(futures), "text", "pk_binance_trade", "bk_binance_trade", run_id)


def hub_binance_transaction(transactions_spot: DataFrame, transactions_futures: DataFrame, run_id: str) -> DataFrame:
    spot = occurrences(transactions_spot, TRANSACTION_KEY).selectExpr(f"{SPOT_TRANSACTION_TEXT} as text")
    futures = occurrences(transactions_futures, ["transaction_id"]).selectExpr(f"{FUTURES_TRANSACTION_TEXT} as text")
    return hub(spot.unionByName(futures), "text", "pk_binance_transaction", "bk_crypto_transaction", run_id)


def sat_binance_order(orders_spot: DataFrame, run_id: str, group_rows: int = GROUP_ROWS) -> DataFrame:
    filled = orders_spot.filter(FILLED).drop("status")
    numbered = number_occurrences(filled, ORDER_KEY, ["trading_total"], group_rows=group_rows)
    attributes = {
        "order_at": second("order_utc_at"),
        "platform": "'binance'",
        "wallet": "'spot'",
        "side": "side",
        "pair": "pair",
        "type": "type",
        "order_amount": _amount("order_amount"),
        "order_coin": coin_text("order_amount"),
        "order_price": money("order_price"),
        "executed_amount": _amount("executed"),
        "executed_price": money("average_price"),
        "trade_amount": _amount("trading_total"),
        "trade_coin": coin_text("trading_total"),
    }
    return satellite(numbered, ORDER_TEXT, "fk_binance_order", attributes, run_id)


def sat_binance_payin(payins: DataFrame, run_id: str) -> DataFrame:
    attributes = {
        "platform": "'binance'",
        "payin_at": second("payin_local_at"),
        "amount": from_text("amount", 9, 2),
        "fee_amount": from_text("fee", 9, 2),
        "coin": "coin",
        "payment_method": "payment_method",
    }
    return satellite(payins.filter(SUCCESSFUL), PAYIN_TEXT, "fk_binance_payin", attributes, run_id)


def sat_binance_trade(
    trades_spot: DataFrame, trades_futures: DataFrame, run_id: str, group_rows: int = GROUP_ROWS
) -> DataFrame:
    def attributes(wallet: str, pair: str, executed: str, **special: str) -> dict[str, str]:
        return {
            "trade_at": second("trade_utc_at"),
            "platform": "'binance'",
            "wallet": wallet,
            "side": "side",
            "pair": pair,
            "trade_amount": _amount("amount"),
            "trade_coin": special["trade_coin"],
            "fee_amount": _amount("fee"),
            "fee_coin": coin_text("fee"),
            "executed_amount": _amount(executed),
            "executed_coin": special["executed_coin"],
            "realized_profit": special["realized_profit"],
        }

    of_spot = attributes(
        SPOT,
        pair="pair",
        executed="executed",
        trade_coin=coin_text("amount"),
        executed_coin=coin_text("executed"),
        realized_profit="cast(null as decimal(18,8))",
    )
    of_futures = attributes(
        FUTURES,
        pair="symbol",
        executed="quantity",
        trade_coin="'UDST'",  # fixed value, spelled like this in existing ledgers
        executed_coin="replace(symbol, 'USDT', '')",
        realized_profit=money("realized_profit"),
    )
    spot = number_occurrences(trades_spot, TRADE_KEY, ["amount"], group_rows=group_rows)
    futures = number_occurrences(trades_futures, ["trade_id"], ["amount"], group_rows=group_rows)
    return satellite(spot, SPOT_TRADE_TEXT, "fk_binance_trade", of_spot, run_id).unionByName(
        satellite(futures, FUTURES_TRADE_TEXT, "fk_binance_trade", of_futures, run_id)
    )


def sat_binance_transaction(
    transactions_spot: DataFrame, transactions_futures: DataFrame, run_id: str, group_rows: int = GROUP_ROWS
) -> DataFrame:
    def attributes(wallet: str, from_wallet: str, operation: str, change: str, coin: str) -> dict[str, str]:
        return {
            "transaction_at": second("transaction_utc_at"),
            "wallet": wallet,
            "from_wallet": from_wallet,
            "operation": operation,
            "change_amount": money(change),
            "coin": coin,
        }

    origin = f"if(type = 'TRANSFER', {SPOT}, {FUTURES})"
    of_spot = attributes(SPOT, "account", "operation", "change", "coin")
    of_futures = attributes(FUTURES, origin, "type", "amount", "asset")
    spot = number_occurrences(transactions_spot, TRANSACTION_KEY, ["change"], group_rows=group_rows)
    futures = number_occurrences(
        transactions_futures, ["transaction_id"], ["amount", "type"], group_rows=group_rows
    )
    return satellite(spot, SPOT_TRANSACTION_TEXT, "fk_binance_transaction", of_spot, run_id).unionByName(
        satellite(futures, FUTURES_TRANSACTION_TEXT, "fk_binance_transaction", of_futures, run_id)
    )
