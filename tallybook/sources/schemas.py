"""Columns of the exchange exports.

Amounts arrive as text, epoch times as milliseconds.  The column names are
fixed values: the exchanges choose them.
"""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DecimalType, LongType, StringType, StructField, StructType, TimestampType

TYPES = {
    "string": StringType(),
    "bigint": LongType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
    "decimal(18,4)": DecimalType(18, 4),
    "decimal(18,8)": DecimalType(18, 8),
}


def _columns(*groups: tuple[str, str]) -> StructType:
    return StructType([StructField(name, TYPES[dtype]) for names, dtype in groups for name in names.split()])


SCHEMAS: dict[str, StructType] = {
    "binance_payins": _columns(
        ("order_id", "string"), ("payin_local_at", "timestamp"), ("amount fee coin payment_method status", "string")
    ),
    "binance_orders_spot": _columns(
        ("side", "string"),
        ("order_utc_at", "timestamp"),
        ("pair type status order_amount order_price executed average_price trading_total", "string"),
    ),
    "binance_trades_spot": _columns(
        ("side", "string"), ("trade_utc_at", "timestamp"), ("pair amount fee executed", "string")
    ),
    "binance_trades_futures": _columns(
        ("trade_id", "string"),
        ("trade_utc_at", "timestamp"),
        ("side symbol amount fee quantity realized_profit", "string"),
    ),
    "binance_transactions_spot": _columns(
        ("account coin operation", "string"), ("transaction_utc_at", "timestamp"), ("change", "string")
    ),
    "binance_transactions_futures": _columns(
        ("transaction_id", "string"), ("transaction_utc_at", "timestamp"), ("type amount asset", "string")
    ),
    "bybit_trades": _columns(
        ("execId orderId symbol", "string"),
        ("execTime", "bigint"),
        (
            "execType side orderType execQty orderQty execPrice markPrice orderPrice execValue execFee feeCurrency",
            "string",
        ),
    ),
    "bybit_orders": _columns(
        ("orderId symbol side orderType orderStatus", "string"),
        ("createdTime", "bigint"),
        ("qty price cumExecValue cumExecFee", "string"),
    ),
    "bybit_pnl": _columns(
        (
            "orderId symbol side orderType qty avgEntryPrice cumEntryValue avgExitPrice cumExitValue orderPrice"
            " closedPnl",
            "string",
        ),
    ),
    "bybit_klines_1m_usdt_eur": _columns(
        ("klineAt", "bigint"),
        ("openPrice highPrice lowPrice closePrice", "decimal(18,8)"),
        ("volume", "decimal(18,4)"),
        ("turnover", "decimal(18,8)"),
    ),
    "kraken_positions": _columns(
        ("accountUid executionUid tradeable updateReason tradeType", "string"),
        ("fillTime timestamp", "bigint"),
        ("newPosition oldPosition fee feeCurrency realizedPnL executionSize executionPrice positionChange", "string"),
        ("fundingRealizationTime", "bigint"),
        ("realizedFunding newAverageEntryPrice oldAverageEntryPrice", "string"),
    ),
    "kraken_transactions": _columns(
        ("id", "bigint"),
        (
            "booking_uid execution date info asset contract margin_account mark_price trade_price funding_rate"
            " realized_pnl realized_funding new_balance old_balance fee liquidation_fee new_average_entry_price"
            " old_average_entry_price",
            "string",
        ),
    ),
    "kraken_tickers": _columns(
        ("symbol tag pair", "string"),
        ("suspended postOnly", "boolean"),
        (
            "lastTime last lastSize bid bidSize ask askSize markPrice indexPrice vwap24h open24h high24h low24h"
            " change24h vol24h volumeQuote openInterest fundingRate fundingRatePrediction",
            "string",
        ),
    ),
    "kraken_ohlc_eur_usd": _columns(
        ("time", "bigint"), ("open high low close", "decimal(18,8)"), ("volume", "bigint")
    ),
}
