"""The exchange exports, derived from the test tables.

The statements run in Spark and in DuckDB alike, except for ``{MS}(x)``, the
epoch milliseconds of a time rounded down, and ``{TWICE}``, which unfolds a row
into two with the values 0 and 1.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tallybook.session import prepare
from tallybook.sources.schemas import SCHEMAS
from tallybook.sources.tables import Reader, conform

SPARK_MS = "timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', cast({0} as timestamp_ntz))"
DUCKDB_MS = "(epoch_us({0}) // 1000)"
SPARK_TWICE = "explode(array(0, 1))"
DUCKDB_TWICE = "unnest([0, 1])"

EXPORTS = {
    "binance_payins": """
        select
            cast(o_orderkey as string) order_id,
            o_orderdate payin_local_at,
            cast(cast(o_totalprice as decimal(18,2)) as string) amount,
            cast(cast(o_custkey % 7 as decimal(18,3)) + 0.125 as string) fee,
            'EUR' coin,
            case when o_custkey % 2 = 0 then 'Bank Transfer' else 'Card' end payment_method,
            case when o_orderstatus = 'P' then 'Failed' else 'Successful' end status
        from orders
    """,
    "binance_orders_spot": """
        select
            case when o_orderkey % 2 = 0 then 'BUY' else 'SELL' end side,
            o_orderdate order_utc_at,
            'C' || cast(o_custkey % 5 as string) || 'USDT' pair,
            case when o_orderkey % 3 = 0 then 'MARKET' else 'LIMIT' end type,
            case o_orderstatus when 'F' then 'FILLED' when 'O' then 'NEW' else 'CANCELED' end status,
            cast(cast(o_custkey as decimal(18,4)) as string) || 'ETH' order_amount,
            cast(cast(o_totalprice as decimal(18,2)) as string) order_price,
            cast(cast(o_custkey as decimal(18,4)) as string) || 'ETH' executed,
            cast(cast(o_totalprice as decimal(18,2)) as string) average_price,
            cast(cast(o_totalprice as decimal(18,2)) as string) || 'USDT' trading_total
        from orders
    """,
    "binance_trades_spot": """
        select
            case when l_linestatus = 'O' then 'BUY' else 'SELL' end side,
            l_shipdate trade_utc_at,
            'C' || cast(l_suppkey % 5 as string) || 'USDT' pair,
            cast(cast(l_extendedprice as decimal(18,2)) as string) || 'USDT' amount,
            cast(cast(l_tax as decimal(18,4)) as string) || 'BNB' fee,
            cast(cast(l_quantity as decimal(18,4)) as string) || 'ETH' executed
        from lineitem
    """,
    "binance_trades_futures": """
        select
            cast(event_id as string) trade_id,
            ts trade_utc_at,
            case when event_type in ('click', 'view') then 'BUY' else 'SELL' end side,
            'C' || cast(user_id % 5 as string) || 'USDT' symbol,
            cast(cast(value as decimal(18,2)) as string) amount,
            cast(cast(value as decimal(18,2)) as string) || 'USDT' fee,
            cast(cast(1 + event_id % 7 as decimal(18,4)) as string) quantity,
            case when event_id % 4 = 0 then cast(cast(value as decimal(18,2)) as string) end realized_profit
        from events
    """,
    "binance_transactions_spot": """
        select
            case when l_returnflag = 'R' then 'USD-M Futures' else 'Spot' end account,
            'C' || cast(l_suppkey % 4 as string) coin,
            case when l_linestatus = 'O' then 'Transaction Buy' else 'Transaction Sold' end operation,
            l_shipdate transaction_utc_at,
            cast(case when l_linestatus = 'O' then cast(l_extendedprice as decimal(18,2)) else -cast(l_extendedprice as decimal(18,2)) end as string) change
        from lineitem
    """,
    "binance_transactions_futures": """
        select
            cast(event_id - event_id % 2 as string) transaction_id,
            ts transaction_utc_at,
            case event_type when 'signup' then 'TRANSFER' when 'purchase' then 'REALIZED_PNL' when 'error' then 'FUNDING_FEE' else 'COMMISSION' end type,
            cast(case when event_type in ('signup', 'purchase') then cast(value as decimal(18,2)) else -cast(value as decimal(18,2)) end as string) amount,
            'C' || cast(user_id % 4 as string) asset
        from events
    """,
    "bybit_trades": """
        select
            'x' || cast(event_id as string) execId,
            'o' || cast(event_id - event_id % 3 as string) orderId,
            'SYM' || cast(user_id % 3 as string) || 'USDT' symbol,
            {MS}(ts) + 1000 * d execTime,
            case when event_id % 13 = 0 then 'Funding' else 'Trade' end execType,
            case when event_type in ('click', 'view') or (event_type = 'error' and event_id % 2 = 0) then 'Buy' else 'Sell' end side,
            case when event_id % 3 = 0 then 'Market' else 'Limit' end orderType,
            cast(1 + event_id % 7 as string) execQty,
            cast(9 as string) orderQty,
            cast(cast(value as decimal(18,2)) as string) execPrice,
            cast(cast(value as decimal(18,2)) as string) markPrice,
            cast(cast(value as decimal(18,2)) as string) orderPrice,
            cast(cast(value as decimal(18,2)) * (1 + event_id % 7) as string) execValue,
            cast(cast(value as decimal(18,2)) * 0.001 as string) execFee,
            'USDT' feeCurrency
        from (select *, {TWICE} d from events) copies
        where d = 0 or event_id % 10 = 0
    """,
    "bybit_orders": """
        select
            'o' || cast(order_no as string) orderId,
            'SYM' || cast(user_id % 3 as string) || 'USDT' symbol,
            case when event_type in ('click', 'view') then 'Buy' else 'Sell' end side,
            'Limit' orderType,
            case when d = 1 then 'Filled' else 'New' end orderStatus,
            {MS}(ts) + 60000 * d createdTime,
            cast(units as string) qty,
            cast(worth as string) price,
            cast(worth * units as string) cumExecValue,
            cast(worth * 0.001 as string) cumExecFee
        from (
            select *, {TWICE} d
            from (
                select event_id - event_id % 3 order_no, min_by(user_id, event_id) user_id,
                    min_by(event_type, event_id) event_type, min(ts) ts, cast(sum(1 + event_id % 7) as bigint) units,
                    max(cast(value as decimal(18,2))) worth
                from events
                group by event_id - event_id % 3
            ) grouped
        ) copies
        where d = 0 or order_no % 2 = 0
    """,
    "bybit_pnl": """
        select
            'o' || cast(order_no as string) orderId,
            'SYM' || cast(user_id % 3 as string) || 'USDT' symbol,
            'Sell' side,
            'Market' orderType,
            cast(units as string) qty,
            cast(worth as string) avgEntryPrice,
            cast(worth * 2 as string) cumEntryValue,
            cast(worth + 1 as string) avgExitPrice,
            cast(worth * 2 + 2 as string) cumExitValue,
            cast(worth as string) orderPrice,
            cast(2 as string) closedPnl
        from (
            select event_id - event_id % 3 order_no, min_by(user_id, event_id) user_id, cast(sum(1 + event_id % 7) as bigint) units,
                max(cast(value as decimal(18,2))) worth
            from events
            group by event_id - event_id % 3
        ) closed
    """,
    "bybit_klines_1m_usdt_eur": """
        select
            {MS}(m) klineAt,
            cast(0.9 + cast(n % 100 as decimal(9,0)) / 1000 + 0.00009 as decimal(18,8)) openPrice,
            cast(0.99990000 as decimal(18,8)) highPrice,
            cast(0.90000000 as decimal(18,8)) lowPrice,
            cast(0.90009 as decimal(18,8)) + cast(n % 100 as decimal(9,0)) * cast(0.001 as decimal(9,3)) closePrice,
            cast(n + d as decimal(18,4)) volume,
            cast(n as decimal(18,8)) turnover
        from (
            select m, n, {TWICE} d
            from (select date_trunc('minute', ts) m, min(event_id) n from events group by date_trunc('minute', ts)) g
        ) copies
        where n % 17 <> 0 and (d = 0 or n % 10 = 0)
    """,
    "kraken_positions": """
        select
            'acc' accountUid,
            case when event_type = 'signup' then null else 'e' || cast(event_id as string) end executionUid,
            'PF_X' || cast(user_id % 3 as string) || 'USD' tradeable,
            case when event_type = 'signup' then 'fundingRealisation' when event_type = 'error' then 'liquidation' else 'trade' end updateReason,
            'userExecution' tradeType,
            {MS}(ts) fillTime,
            {MS}(ts) timestamp,
            cast(event_id % 5 as string) newPosition,
            cast(event_id % 3 as string) oldPosition,
            case when event_type = 'signup' then null else cast(cast(value as decimal(18,2)) * 0.001 as string) end fee,
            'USD' feeCurrency,
            case when event_id % 4 = 0 then cast(cast(value as decimal(18,2)) as string) end realizedPnL,
            cast(1 + event_id % 7 as string) executionSize,
            cast(cast(value as decimal(18,2)) as string) executionPrice,
            cast(event_id % 5 - event_id % 3 as string) positionChange,
            case when event_type = 'signup' then {MS}(ts) end fundingRealizationTime,
            case when event_type = 'signup' then cast(cast(value as decimal(18,2)) * 0.01 as string) end realizedFunding,
            cast(cast(value as decimal(18,2)) as string) newAverageEntryPrice,
            cast(cast(value as decimal(18,2)) as string) oldAverageEntryPrice
        from events
    """,
    "kraken_transactions": """
        select
            event_id id,
            'b' || cast(event_id - event_id % 2 as string) booking_uid,
            'x' || cast(event_id as string) execution,
            replace(cast(ts as string), ' ', 'T') || 'Z' date,
            event_type info,
            'usd' asset,
            'pf_x' || cast(user_id % 3 as string) || 'usd' contract,
            'flex' margin_account,
            cast(cast(value as decimal(18,2)) as string) mark_price,
            cast(cast(value as decimal(18,2)) as string) trade_price,
            '0.0001' funding_rate,
            cast(cast(value as decimal(18,2)) as string) realized_pnl,
            cast(null as string) realized_funding,
            cast(cast(value as decimal(18,2)) as string) new_balance,
            cast(cast(value as decimal(18,2)) as string) old_balance,
            '0.01' fee,
            cast(null as string) liquidation_fee,
            '1' new_average_entry_price,
            '1' old_average_entry_price
        from events
    """,
    "kraken_tickers": """
        select
            'PF_P' || cast(p_partkey as string) || 'USD' symbol,
            case when p_size % 2 = 0 then 'perpetual' else 'month' end tag,
            'P' || cast(p_partkey as string) || ':USD' pair,
            p_size > 45 suspended,
            false postOnly,
            case when p_size = 1 then 'n/a' else '2024-01-01T00:00:00.123456Z' end lastTime,
            cast(cast(p_retailprice as decimal(18,2)) as string) last,
            cast(p_size as string) lastSize,
            cast(cast(p_retailprice as decimal(18,2)) - 1 as string) bid,
            cast(p_size * 1000 as string) bidSize,
            cast(cast(p_retailprice as decimal(18,2)) + 1 as string) ask,
            cast(p_size * 1000 as string) askSize,
            cast(cast(p_retailprice as decimal(18,2)) as string) markPrice,
            cast(cast(p_retailprice as decimal(18,2)) as string) indexPrice,
            cast(cast(p_retailprice as decimal(18,2)) as string) vwap24h,
            cast(cast(p_retailprice as decimal(18,2)) as string) open24h,
            cast(cast(p_retailprice as decimal(18,2)) as string) high24h,
            cast(cast(p_retailprice as decimal(18,2)) as string) low24h,
            cast(p_size - 25 as string) change24h,
            cast(p_size * 5000 as string) vol24h,
            cast(p_size * 700 as string) volumeQuote,
            cast(p_size * 90 as string) openInterest,
            '0.0001' fundingRate,
            case when p_size % 2 = 0 then '0.0002' end fundingRatePrediction
        from part
    """,
    "kraken_ohlc_eur_usd": """
        select
            {MS}(m) time,
            cast(1.05 as decimal(18,8)) open,
            cast(1.20 as decimal(18,8)) high,
            cast(1.00 as decimal(18,8)) low,
            cast(1.05009 as decimal(18,8)) + cast(n % 100 as decimal(9,0)) * cast(0.001 as decimal(9,3)) close,
            n volume
        from (
            select m, n, {TWICE} d
            from (select date_trunc('minute', ts) m, min(event_id) n from events group by date_trunc('minute', ts)) g
        ) copies
        where n % 17 <> 0 and (d = 0 or n % 10 = 0)
    """,
}



def _filled(export: str, ms: str, twice: str) -> str:
    text = EXPORTS[export].replace("{TWICE}", twice)
    return re.sub(r"\{MS\}\((\w+)\)", lambda m: ms.format(m[1]), text)


def spark_sql(export: str) -> str:
    return _filled(export, SPARK_MS, SPARK_TWICE)


def duckdb_sql(export: str) -> str:
    return _filled(export, DUCKDB_MS, DUCKDB_TWICE)


def export_reader(spark: SparkSession, folder: str) -> Reader:
    """Derive an export from the parquet tables in ``folder``."""
    prepare(spark)
    table = cache(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))

    def read(export: str) -> DataFrame:
        sql = spark_sql(export)
        name = re.search(r"\bfrom (orders|lineitem|events|part)\b", sql)[1]
        derived = spark.sql(re.sub(rf"\bfrom {name}\b", "from {" + name + "}", sql), **{name: table(name)})
        typed = [
            F.col(f.name).cast(f.dataType).alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in SCHEMAS[export]
        ]
        return conform(derived.select(*typed), export)

    return read
