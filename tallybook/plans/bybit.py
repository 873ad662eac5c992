"""Raw vault of the Bybit exports.

The exports spell symbols in capitals.  The trade hub lowers the symbol in its
key, the trade satellite and link do not, and the order hub alone puts a
version number into its key; existing ledgers hold such keys, so they are the
default.  ``normalise_keys=True`` makes all keys of a record the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybook.functions.decimals import cut, from_text, money
from tallybook.functions.keys import hashed, key_text, with_audit
from tallybook.functions.times import second_from_millis
from tallybook.operators.dedup import keep_one
from tallybook.plans.vault import hub, link, named, satellite

ORDER_TEXT = key_text("'bybit'", "orderId")
PNL_TEXT = key_text("'bybit'", "lower(symbol)", "orderId")
KLINE_TEXT = key_text("'usdteur'", "'1m'", "klineAt")
TRADE_TEXT = key_text("'bybit'", "symbol", "execId")
LOWERED_TRADE_TEXT = key_text("'bybit'", "lower(symbol)", "execId")


def latest_execution(trades: DataFrame) -> DataFrame:
    return keep_one(trades, ["execId"], ["execTime desc", "symbol"])


def latest_order(orders: DataFrame) -> DataFrame:
    return keep_one(orders, ["orderId"], ["createdTime desc"])


def fullest_candle(klines: DataFrame) -> DataFrame:
    return keep_one(klines, ["klineAt"], ["volume desc"])


def hub_bybit_kline(klines: DataFrame, run_id: str) -> DataFrame:
    # The key holds all that identifies a candle, whichever copy is kept.
    return hub(klines.select("klineAt").distinct(), KLINE_TEXT, "pk_bybit_kline", "bk_bybit_kline", run_id)


def hub_bybit_order(orders: DataFrame, run_id: str, normalise_keys: bool = False) -> DataFrame:
    key = hashed(ORDER_TEXT if normalise_keys else key_text(ORDER_TEXT, "'1'"))
    kept = orders.select("orderId").distinct()
    return with_audit(kept.selectExpr(*named({"pk_bybit_order": key, "bk_bybit_order": ORDER_TEXT})), run_id, after=2)


def hub_bybit_pnl(pnl: DataFrame, run_id: str) -> DataFrame:
    return hub(pnl, PNL_TEXT, "pk_bybit_pnl", "bk_bybit_pnl", run_id)


def hub_bybit_trade(trades: DataFrame, run_id: str) -> DataFrame:
    kept = latest_execution(trades.select("execId", "execTime", "symbol"))
    return hub(kept, LOWERED_TRADE_TEXT, "pk_bybit_trade", "bk_crypto_trade", run_id)


def sat_bybit_kline(klines: DataFrame, run_id: str) -> DataFrame:
    start = second_from_millis("klineAt")
    attributes = {
        "bk_bybit_kline": KLINE_TEXT,
        "symbol": "'USDTEUR'",
        "kline_interval": "'1m'",
        "kline_start_at": start,
        "kline_end_at": f"{start} + interval 60 seconds",
        "open_price": cut("openPrice", 18, 8),
        "high_price": cut("highPrice", 18, 8),
        "low_price": cut("lowPrice", 18, 8),
        "close_price": cut("closePrice", 18, 8),
        "volume": cut("volume", 18, 4),
        "turnover": cut("turnover", 18, 8),
    }
    described = {"fk_bybit_kline": hashed(KLINE_TEXT)} | attributes
    return with_audit(fullest_candle(klines).selectExpr(*named(described)), run_id, after=2)


def sat_bybit_order(orders: DataFrame, run_id: str) -> DataFrame:
    attributes = {
        "platform": "'bybit'",
        "symbol": "symbol",
        "side": "side",
        "order_id": "orderId",
        "order_type": "orderType",
        "order_status": "orderStatus",
        "order_at": second_from_millis("createdTime"),
        "quantity": from_text("qty", 18, 4),
        "price": money("price"),
        "cumumlative_exec_value": money("cumExecValue"),  # fixed value, spelled like this in existing ledgers
        "cumulative_exec_fee": money("cumExecFee"),
    }
    return satellite(latest_order(orders), ORDER_TEXT, "fk_bybit_order", attributes, run_id)


def sat_bybit_pnl(pnl: DataFrame, run_id: str) -> DataFrame:
    attributes = {
        "platform": "'bybit'",
        "symbol": "symbol",
        "side": "side",
        "order_type": "orderType",
        "quantity": from_text("qty", 18, 4),
        "avg_entry_price": money("avgEntryPrice"),
        "cum_entry_value": money("cumEntryValue"),
        "avg_exit_price": money("avgExitPrice"),
        "cum_exit_value": money("cumExitValue"),
        "order_price": money("orderPrice"),
        "closed_pnl": money("closedPnl"),
    }
    return satellite(pnl, PNL_TEXT, "fk_bybit_pnl", attributes, run_id)


def sat_bybit_trade(trades: DataFrame, run_id: str, normalise_keys: bool = False) -> DataFrame:
    attributes = {
        "symbol": "symbol",
        "order_type": "orderType",
        "trade_at": second_from_millis("execTime"),
        "side": "side",
        "execution_type": "execType",
        "quantity": from_text("execQty", 18, 4),
        "order_quantity": from_text("orderQty", 18, 4),
        "price": money("execPrice"),
        "mark_price": money("markPrice"),
        "order_price": money("orderPrice"),
        "execution_value": money("execValue"),
        "fee_amount": from_text("execFee", 18, 4),
        "fee_currency": "feeCurrency",
    }
    text = LOWERED_TRADE_TEXT if normalise_keys else TRADE_TEXT
    return satellite(latest_execution(trades.drop("orderId")), text, "fk_bybit_trade", attributes, run_id)


def link_bybit_pnl_bybit_order(pnl: DataFrame, run_id: str) -> DataFrame:
    ends = {"fk_bybit_pnl": PNL_TEXT, "fk_bybit_order": ORDER_TEXT}
    return link(pnl, ("pk_bybit_pnl_bybit_order", PNL_TEXT), ends, run_id)


def link_bybit_trade_bybit_order(trades: DataFrame, run_id: str, normalise_keys: bool = False) -> DataFrame:
    text = LOWERED_TRADE_TEXT if normalise_keys else TRADE_TEXT
    ends = {"fk_bybit_trade": text, "fk_bybit_order": ORDER_TEXT}
    return link(trades, ("pk_bybit_trade_bybit_order", text), ends, run_id)
