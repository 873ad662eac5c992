"""Raw vault of the Kraken futures exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.decimals import from_text, money
from tallybook.functions.keys import key_text
from tallybook.functions.times import from_iso, from_iso_or_null, from_millis
from tallybook.operators.dedup import keep_one
from tallybook.plans.vault import hub, satellite

KRAKEN = "'kraken_futures'"
IS_FUNDING = "updateReason = 'fundingRealisation'"

OHLC_TEXT = key_text("'eur_usd_1m'", "`time`")
TICKER_TEXT = key_text(KRAKEN, "lower(symbol)", "lower(tag)")
TRANSACTION_TEXT = key_text(KRAKEN, "booking_uid")
# Funding is identified by its contract, an execution by its id.
FUNDING_TEXT = key_text(KRAKEN, "'funding'", "lower(tradeable)", "`timestamp`")
POSITION_TEXT = f"if({IS_FUNDING}, {FUNDING_TEXT}, {key_text(KRAKEN, 'executionUid', '`timestamp`')})"


def one_position(positions: DataFrame, normalise_keys: bool = False) -> DataFrame:
    """One row per execution id and time.

    Funding rows without an id share one group whatever their contract, so of
    two contracts funded at the same time one is kept.  ``normalise_keys``
    tells them apart by contract.
    """
    keys, order = ["executionUid", "timestamp"], ["updateReason", "tradeable"]
    if not normalise_keys:
        return keep_one(positions, keys, order)
    told_apart = positions.withColumn("_contract", F.expr(f"if({IS_FUNDING}, lower(tradeable), null)"))
    return keep_one(told_apart, [*keys, "_contract"], order).drop("_contract")


def one_candle(ohlc: DataFrame) -> DataFrame:
    return keep_one(ohlc, ["time"])


def earliest_booking(transactions: DataFrame) -> DataFrame:
    return keep_one(transactions, ["booking_uid"], ["date"])


def hub_kraken_ohlc(ohlc: DataFrame, run_id: str) -> DataFrame:
    return hub(ohlc.select("time").distinct(), OHLC_TEXT, "pk_kraken_ohlc", "bk_kraken_ohlc", run_id)


def hub_kraken_position(positions: DataFrame, run_id: str, normalise_keys: bool = False) -> DataFrame:
    used = positions.select("executionUid", "timestamp", "updateReason", "tradeable")
    kept = one_position(used, normalise_keys)
    return hub(kept, POSITION_TEXT, "pk_kraken_position", "bk_kraken_position", run_id)


def hub_kraken_ticker(tickers: DataFrame, run_id: str) -> DataFrame:
    return hub(tickers, TICKER_TEXT, "pk_kraken_ticker", "bk_kraken_ticker", run_id)


def hub_kraken_transaction(transactions: DataFrame, run_id: str) -> DataFrame:
    kept = transactions.select("booking_uid").distinct()
    return hub(kept, TRANSACTION_TEXT, "pk_kraken_transaction", "bk_kraken_transaction", run_id)


def sat_kraken_ohlc(ohlc: DataFrame, run_id: str) -> DataFrame:
    attributes = {
        "ohlc_at": from_millis("`time`"),
        "symbol": "'PF_EURUSD'",
        **{f"{price}_price": price for price in ("open", "high", "low", "close")},
        "volume": "volume",
    }
    return satellite(one_candle(ohlc), OHLC_TEXT, "fk_kraken_ohlc", attributes, run_id)


def sat_kraken_position(positions: DataFrame, run_id: str, normalise_keys: bool = False) -> DataFrame:
    attributes = {
        "account_id": "accountUid",
        "execution_id": "executionUid",
        "contract": "lower(tradeable)",
        "update_reason": "updateReason",
        "trade_type": "tradeType",
        "fill_at": from_millis("fillTime"),
        "update_at": from_millis("`timestamp`"),
        "new_position": money("newPosition"),
        "old_position": money("oldPosition"),
        "fee": money("fee"),
        "fee_currency": "feeCurrency",
        "realized_pnl": money("realizedPnL"),
        "execution_size": money("executionSize"),
        "execution_price": money("executionPrice"),
        "position_change": money("positionChange"),
        "funding_at": from_millis("fundingRealizationTime"),
        "realized_funding": money("realizedFunding"),
        "new_average_entry_price": money("newAverageEntryPrice"),
        "old_average_entry_price": money("oldAverageEntryPrice"),
    }
    kept = one_position(positions, normalise_keys)
    return satellite(kept, POSITION_TEXT, "fk_kraken_position", attributes, run_id)


def sat_kraken_ticker(tickers: DataFrame, run_id: str) -> DataFrame:
    attributes = {
        "tag": "tag",
        "symbol": "symbol",
        "pair": "pair",
        "is_suspended": "suspended",
        "is_post_only": "postOnly",
        "last_trade_at": from_iso_or_null("lastTime"),
        "last_price": money("`last`"),
        "last_size": money("lastSize"),
        "bid_price": money("bid"),
        "bid_size": from_text("bidSize", 38, 8),
        "ask_price": money("ask"),
        "ask_size": from_text("askSize", 38, 8),
        "mark_price": money("markPrice"),
        "index_price": money("indexPrice"),
        "vwap_24h": money("vwap24h"),
        "open_24h": money("open24h"),
        "high_24h": money("high24h"),
        "low_24h": money("low24h"),
        "change_24h": money("change24h"),
        "volume_24h": from_text("vol24h", 38, 8),
        "volume_quote": money("volumeQuote"),
        "open_interest": from_text("openInterest", 38, 8),
        "funding_rate": money("fundingRate"),
        "funding_rate_prediction": money("fundingRatePrediction"),
    }
    return satellite(tickers, TICKER_TEXT, "fk_kraken_ticker", attributes, run_id)


def sat_kraken_transaction(transactions: DataFrame, run_id: str) -> DataFrame:
    texts = ["info", "asset", "contract", "margin_account"]
    amounts = [
        "mark_price",
        "trade_price",
        "funding_rate",
        "realized_pnl",
        "realized_funding",
        "new_balance",
        "old_balance",
        "fee",
        "liquidation_fee",
        "new_average_entry_price",
        "old_average_entry_price",
    ]
    attributes = {
        "transaction_number": "id",
        "booking_uid": "booking_uid",
        "execution": "execution",
        "transaction_at": from_iso("`date`"),
        **{name: name for name in texts},
        **{name: money(name) for name in amounts},
    }
    return satellite(earliest_booking(transactions), TRANSACTION_TEXT, "fk_kraken_transaction", attributes, run_id)
