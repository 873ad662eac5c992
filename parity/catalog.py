"""Every model and operator as a query over a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from parity.exports import export_reader
from tallybook.functions import decimals, keys, text, times
from tallybook.operators import balance, checks, dedup, fifo, numbering, position, rates
from tallybook.operators.ordered import GROUP_ROWS, arrange, parts_needed
from tallybook.plans import business, bybit, kraken, marts
from tallybook.plans.models import HUB_KEYS, MODELS, write_model
from tallybook.session import ensure_checkpoint_dir
from tallybook.sources.schemas import SCHEMAS
from tallybook.sources.tables import conform

Query = Callable[[SparkSession, str], DataFrame]

# Groups above this size are cut into parts by the ``*_in_parts`` queries.
SMALL_GROUP = 2_000


class Tables:
    """Exports and models of one folder, derived when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._read = export_reader(spark, folder)
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._derive(name)
        return self._known[name]

    def _derive(self, name: str) -> DataFrame:
        if name not in MODELS:
            return self._read(name)
        if name == "calc_bybit_pnl_per_trade":
            return business.calc_bybit_pnl_per_trade(
                self["sat_bybit_trade"], self["sat_bybit_kline"], sizes_from=self["bybit_trades"]
            )
        model = MODELS[name]
        return model.build(*[self[t] for t in model.reads], "run")

    def bybit_base(self) -> DataFrame:
        return business.bybit_base(self["sat_bybit_trade"], self["sat_bybit_kline"])

    def bybit_rates(self) -> DataFrame:
        return rates.rates_by_minute(self["sat_bybit_kline"], "kline_start_at")


def comparable(df: DataFrame) -> DataFrame:
    """Leave out the audit columns and give times without zone."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in df.schema
            if f.name not in ("record_source", "load_dts")
        ]
    )


def _query(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: comparable(build(Tables(spark, folder)))


def _model(name: str) -> Query:
    """A model, or an export as it is read."""
    return _query(lambda t: t[name])


def _natural_key(group_rows: int) -> Callable[[Tables], DataFrame]:
    def build(t: Tables) -> DataFrame:
        numbered = numbering.number_occurrences(
            t["binance_transactions_spot"].drop("transaction_utc_at"),
            ["account", "coin", "operation"],
            ["change"],
            group_rows=group_rows,
        )
        named = keys.key_text("'binance'", "lower(account)", "lower(coin)", "lower(operation)", "r")
        return numbered.selectExpr(
            f"{keys.hashed(named)} as hashed_key", f"{named} as key_text", "change as change_text"
        )

    return build


def _occurrence_counts(t: Tables) -> DataFrame:
    numbered = numbering.occurrences(t["binance_trades_spot"], ["pair", "side"], out="r", chunk_rows=100)
    return numbered.select("pair", "side", "r")


def _running_balance(group_rows: int) -> Callable[[Tables], DataFrame]:
    def build(t: Tables) -> DataFrame:
        changes = t["binance_transactions_futures"].selectExpr(
            "asset",
            f"{times.minute('transaction_utc_at')} as booked_at",
            f"{decimals.money('amount')} as change_amount",
        )
        return balance.running_balance(changes, ["asset"], "booked_at", "change_amount", group_rows=group_rows)

    return build


def _transaction_balance_in_parts(t: Tables) -> DataFrame:
    return business.calc_binance_transaction_accountbalance(
        t["sat_binance_transaction"], "run", group_rows=SMALL_GROUP
    )


def _positions(t: Tables, group_rows: int) -> DataFrame:
    base = t.bybit_base()
    order = ["trade_at", "fk_bybit_trade"]
    parts = parts_needed(t["bybit_trades"], ["symbol"], group_rows)
    return position.position_before(arrange(base, ["symbol"], order, parts), ["symbol"], order, parts)


def _signed_position(group_rows: int) -> Callable[[Tables], DataFrame]:
    return lambda t: _positions(t, group_rows).select("fk_bybit_trade", "symbol", "trade_at", "quantity", "held_before")


def _split_legs(t: Tables) -> DataFrame:
    return position.split_legs(_positions(t, GROUP_ROWS), ["fk_bybit_trade", "symbol", "trade_at", "price"])


def _fifo_match(group_rows: int) -> Callable[[Tables], DataFrame]:
    def build(t: Tables) -> DataFrame:
        matched = fifo.fifo_profit(t.bybit_base(), group_rows=group_rows, sizes_from=t["bybit_trades"])
        return matched.select("fk_bybit_trade", "symbol", "quantity", *fifo.PNL_COLUMNS)

    return build


def _fifo_lots(group_rows: int) -> Callable[[Tables], DataFrame]:
    return lambda t: fifo.fifo_lots(t.bybit_base(), group_rows=group_rows, sizes_from=t["bybit_trades"])


def _fx_at_minute(t: Tables) -> DataFrame:
    rated = rates.fx_at_minute(t["sat_bybit_trade"], t.bybit_rates(), "trade_at")
    return rated.selectExpr(
        "fk_bybit_trade",
        "trade_at",
        "fx_rate",
        f"cast({rates.multiplied('price')} as decimal(28,12)) as price_eur",
        f"{rates.divided('price')} as price_per_rate",
    )


def _fx_shuffled(t: Tables) -> DataFrame:
    """The same without a broadcast, as for a rate table of any size."""
    shuffled = _kraken_rates(t).hint("merge")
    rated = rates.fx_at_minute(t["sat_kraken_position"], shuffled, "fill_at")
    return rated.select("fk_kraken_position", "fill_at", "fx_rate")


def _fx_from_grid(t: Tables) -> DataFrame:
    """The same from a grid of minutes."""
    found = rates.rated(t["sat_kraken_position"], _kraken_rates(t), "fill_at", rates.GRID_BYTES)
    return found.select("fk_kraken_position", "fill_at", "fx_rate")


def _profit_from_grid(t: Tables) -> DataFrame:
    base = business.bybit_base(t["sat_bybit_trade"], t["sat_bybit_kline"], rates.GRID_BYTES)
    matched = fifo.fifo_profit(base, sizes_from=t["bybit_trades"])
    return matched.select("fk_bybit_trade", "symbol", "quantity", *fifo.PNL_COLUMNS)


def _kraken_rates(t: Tables) -> DataFrame:
    return rates.rates_by_minute(t["sat_kraken_ohlc"], "ohlc_at")


def _without_rate(t: Tables) -> DataFrame:
    missing = rates.without_rate(t["sat_bybit_trade"], t.bybit_rates(), "trade_at")
    return missing.select("fk_bybit_trade", "symbol", "trade_at")


def _keep_one(t: Tables) -> DataFrame:
    latest = dedup.keep_one(t["bybit_orders"], ["symbol", "side"], ["createdTime desc", "orderId"])
    return latest.select("symbol", "side", "orderId", "createdTime", "orderStatus")


def _split_amount(t: Tables) -> DataFrame:
    grouped = "concat('1,', executed)"
    return t["binance_trades_spot"].selectExpr(
        "executed",
        f"{text.amount_text('executed')} as amount_text",
        f"{text.amount_text(grouped)} as grouped_text",
        f"{text.amount_text(grouped, strict=True)} as strict_text",
        f"{text.coin_text('executed')} as coin",
        f"{decimals.money(text.amount_text('executed'))} as amount",
    )


def _scalar_functions(t: Tables) -> DataFrame:
    at, transfer = "transaction_utc_at", "type = 'TRANSFER'"
    longer = "concat(amount, '9876543219')"
    longest = "concat(amount, '123456')"  # eight digits behind the point
    iso = f"date_format({at}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"
    five = "cast(5 as decimal(18,8))"
    expressions = {
        "transaction_id": "transaction_id",
        "amount": "amount",
        "two_digits": decimals.from_text(longer, 9, 2),
        "four_digits": decimals.from_text(longer, 18, 4),
        "eight_digits": decimals.money(longer),
        "wide": decimals.from_text(longer, 38, 8),
        "with_exponent": decimals.money("concat(amount, 'e-3')"),
        "cut_number": decimals.cut(f"cast({longer} as decimal(38,12))", 9, 4),
        "malformed": decimals.money("concat(amount, 'x')", on_error="null"),
        "junk_behind_eight": decimals.money(f"concat({longest}, 'BTC')", on_error="null"),
        "junk_behind_nine": decimals.money(f"concat({longest}, '9 1')", on_error="null"),
        "junk_behind_twelve": decimals.money(f"concat({longest}, '9876', if({transfer}, '', '.9'))", on_error="null"),
        "tiny": decimals.money(f"concat({longest}, '9876543219e-1')"),
        "quotient": decimals.quotient(decimals.money("amount"), "1.1234"),
        "epoch": times.epoch_seconds(at),
        "to_second": times.second(at),
        "to_minute": times.minute(at),
        "parsed_millis": times.from_iso(iso),
        "parsed_or_null": times.from_iso_or_null(f"if({transfer}, {iso}, 'n/a')"),
        "berlin_time": times.berlin(at),
        "berlin_by_the_season": times.berlin(f"{at} + make_dt_interval(cast(substring(transaction_id, -2) as int) * 4)"),
        "at_most_five": f"least({decimals.money('amount')}, {five})",
        "at_least_five": f"greatest({decimals.money('amount')}, {five})",
        "snake": text.snake("concat(type, ' x')"),
        "hashed_key": keys.hashed(keys.key_text("'a'", "transaction_id", "asset")),
        "null_with_null": keys.key_text("'a'", f"if({transfer}, asset, null)"),
    }
    return t["binance_transactions_futures"].selectExpr(*[f"{sql} as {name}" for name, sql in expressions.items()])


def _retyped(model: str, export: str, change: Callable[[str], str | None]) -> Query:
    """A model over an export whose columns come in other types; ``change`` names a column's type."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        tables = Tables(spark, folder)
        given = tables[export]
        other = given.select(*[F.col(c).cast(change(t) or t).alias(c) for c, t in given.dtypes])
        tables._known[export] = conform(other, export)
        return comparable(tables[model])

    return run


def _as_text(dtype: str) -> str | None:
    return "string" if dtype == "bigint" or dtype.startswith("decimal") else None


def _whole_numbers(dtype: str) -> str | None:
    return "decimal(20,0)" if dtype == "bigint" else None


def _account_balance_in_parts(t: Tables) -> DataFrame:
    return business.calc_binance_accountbalance(t["sat_binance_transaction"], "run", group_rows=SMALL_GROUP)


def _some_namespace(spark: SparkSession) -> str:
    namespace = f"parity_{uuid4().hex}"
    spark.sql(f"create namespace {namespace} location '{ensure_checkpoint_dir(spark)}/{namespace}'")
    return namespace


def _written(spark: SparkSession, folder: str) -> DataFrame:
    """A model written as a table of another environment, as it is read back."""
    tables = Tables(spark, folder)
    model = MODELS["hub_binance_trade"]
    rows = model.build(*[tables[t] for t in model.reads], "parity run")
    name = write_model(rows, "hub_binance_trade", "test", _some_namespace(spark))
    loaded = F.expr("load_dts is not null and load_dts <= current_timestamp() as loaded")
    return spark.table(name).select("pk_binance_trade", "bk_binance_trade", "record_source", loaded)


def _written_by_time(spark: SparkSession, folder: str) -> DataFrame:
    """A fact table in many files, by ranges of time, as it is read back."""
    tables = Tables(spark, folder)
    name = write_model(tables["fact_bybit_trade"], "fact_bybit_trade", "test", _some_namespace(spark), target_bytes=100_000)
    return comparable(spark.table(name))


def _written_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions with their balance, joined from two written tables that lie by the hash of their key."""
    tables, namespace = Tables(spark, folder), _some_namespace(spark)
    names = MODELS["fact_binance_transaction"].reads
    written = [write_model(tables[name], name, "test", namespace, bucket_rows=2_000) for name in names]
    return comparable(marts.fact_binance_transaction(*[spark.table(name) for name in written], "run"))


def _keys_normalised(t: Tables) -> DataFrame:
    """Trades with an order, when both sides of each key are spelled alike."""
    trades, orders = t["bybit_trades"], t["bybit_orders"]
    hub_trade = bybit.hub_bybit_trade(trades, "run").select(F.col("pk_bybit_trade").alias("fk_bybit_trade"))
    hub_order = bybit.hub_bybit_order(orders, "run", normalise_keys=True).select(
        F.col("pk_bybit_order").alias("fk_bybit_order")
    )
    linked = bybit.link_bybit_trade_bybit_order(trades, "run", normalise_keys=True)
    return (
        linked.select("fk_bybit_trade", "fk_bybit_order")
        .join(hub_trade, "fk_bybit_trade", "left_semi")
        .join(hub_order, "fk_bybit_order", "left_semi")
    )


def _positions_normalised(t: Tables) -> DataFrame:
    return kraken.hub_kraken_position(t["kraken_positions"], "run", normalise_keys=True)


def _hub_key_report(t: Tables) -> DataFrame:
    return checks.key_report({name: (t[name], key) for name, key in HUB_KEYS.items()})


def _check_unique(t: Tables) -> DataFrame:
    return checks.check_unique(t["link_bybit_trade_bybit_order"], "pk_bybit_trade_bybit_order")


def _check_not_null(t: Tables) -> DataFrame:
    return checks.check_not_null(t["sat_kraken_transaction"], "realized_funding").select(
        "fk_kraken_transaction", "booking_uid"
    )


QUERIES: dict[str, Query] = {name: _model(name) for name in MODELS}
QUERIES |= {f"source_{name}": _model(name) for name in SCHEMAS}
QUERIES |= {
    "natural_key": _query(_natural_key(GROUP_ROWS)),
    "natural_key_in_parts": _query(_natural_key(SMALL_GROUP)),
    "occurrences": _query(_occurrence_counts),
    "keep_one": _query(_keep_one),
    "split_amount": _query(_split_amount),
    "scalar_functions": _query(_scalar_functions),
    "fx_at_minute": _query(_fx_at_minute),
    "fx_at_minute_shuffled": _query(_fx_shuffled),
    "fx_from_grid": _query(_fx_from_grid),
    "fifo_match_from_grid": _query(_profit_from_grid),
    "without_rate": _query(_without_rate),
    "signed_position": _query(_signed_position(GROUP_ROWS)),
    "signed_position_in_parts": _query(_signed_position(SMALL_GROUP)),
    "split_legs": _query(_split_legs),
    "fifo_match": _query(_fifo_match(GROUP_ROWS)),
    "fifo_match_in_parts": _query(_fifo_match(SMALL_GROUP)),
    "fifo_lots": _query(_fifo_lots(GROUP_ROWS)),
    "fifo_lots_in_parts": _query(_fifo_lots(SMALL_GROUP)),
    "running_balance": _query(_running_balance(GROUP_ROWS)),
    "running_balance_in_parts": _query(_running_balance(SMALL_GROUP)),
    "transaction_balance_in_parts": _query(_transaction_balance_in_parts),
    "account_balance_in_parts": _query(_account_balance_in_parts),
    "ohlc_from_text": _retyped("sat_kraken_ohlc", "kraken_ohlc_eur_usd", _as_text),
    "kline_from_text": _retyped("sat_bybit_kline", "bybit_klines_1m_usdt_eur", _as_text),
    "position_from_text": _retyped("sat_kraken_position", "kraken_positions", _as_text),
    "trade_from_text": _retyped("sat_bybit_trade", "bybit_trades", _as_text),
    "booking_from_decimal": _retyped("sat_kraken_transaction", "kraken_transactions", _whole_numbers),
    "written_table": _written,
    "written_by_time": _written_by_time,
    "written_by_key": _written_by_key,
    "keys_normalised": _query(_keys_normalised),
    "positions_normalised": _query(_positions_normalised),
    "hub_key_report": _query(_hub_key_report),
    "check_unique": _query(_check_unique),
    "check_not_null": _query(_check_not_null),
}
