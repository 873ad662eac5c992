"""The models in building order, with what they read and how they are kept."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from functools import wraps
from inspect import signature

from pyspark.sql import DataFrame, SparkSession

from tallybook.functions.keys import new_run_id
from tallybook.operators.checks import key_report
from tallybook.operators.ordered import GROUP_ROWS
from tallybook.operators.rates import GRID_BYTES
from tallybook.plans import binance, business, bybit, kraken, marts
from tallybook.session import prepare
from tallybook.sources.sink import namespace, table_name, write_layer
from tallybook.sources.tables import Reader


@dataclass(frozen=True)
class Model:
    """``build`` takes the tables named in ``reads`` and the run id."""

    layer: str
    reads: tuple[str, ...]
    build: Callable[..., DataFrame]
    sort_by: str | None
    bucketed: bool = False

    @property
    def unique_key(self) -> bool:
        """Whether the table is sorted by an MD5 key that de-duplication keeps unique."""
        return (self.sort_by or "")[:3] in ("pk_", "fk_") and self.build.__name__ not in REPEATING


# Tables that are joined to each other by the key they describe: kept by its hash, so that the join needs no shuffle.
JOINED = {"sat_binance_transaction", "calc_binance_transaction_accountbalance"}

# Models without de-duplication: a key may occur in very many rows.
REPEATING = {
    *("hub_binance_payin", "sat_binance_payin", "hub_bybit_pnl", "sat_bybit_pnl", "hub_kraken_ticker"),
    *("sat_kraken_ticker", "link_bybit_pnl_bybit_order", "link_bybit_trade_bybit_order"),
}


def _model(layer: str, build: Callable[..., DataFrame], sort_by: str | None, *reads: str) -> tuple[str, Model]:
    name = build.__name__
    # So are hubs, whose keys are then checked where they lie; not where one key may fill a file.
    bucketed = name in JOINED or name.startswith("hub_") and name not in REPEATING
    return name, Model(layer, reads, build, sort_by, bucketed)


def _without_audit(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    @wraps(build)
    def run(*args, **options):
        return build(*args[:-1], **options)

    return run


TRADES = ("binance_trades_spot", "binance_trades_futures")
TRANSACTIONS = ("binance_transactions_spot", "binance_transactions_futures")
KLINES = "bybit_klines_1m_usdt_eur"

MODELS: dict[str, Model] = dict(
    [
        _model("raw", binance.hub_binance_order, "pk_binance_order", "binance_orders_spot"),
        _model("raw", binance.hub_binance_payin, "pk_binance_payin", "binance_payins"),
        _model("raw", binance.hub_binance_trade, "pk_binance_trade", *TRADES),
        _model("raw", binance.hub_binance_transaction, "pk_binance_transaction", *TRANSACTIONS),
        _model("raw", binance.sat_binance_order, "fk_binance_order", "binance_orders_spot"),
        _model("raw", binance.sat_binance_payin, "fk_binance_payin", "binance_payins"),
        _model("raw", binance.sat_binance_trade, "fk_binance_trade", *TRADES),
        _model("raw", binance.sat_binance_transaction, "fk_binance_transaction", *TRANSACTIONS),
        _model("raw", bybit.hub_bybit_kline, "pk_bybit_kline", KLINES),
        _model("raw", bybit.hub_bybit_order, "pk_bybit_order", "bybit_orders"),
        _model("raw", bybit.hub_bybit_pnl, "pk_bybit_pnl", "bybit_pnl"),
        _model("raw", bybit.hub_bybit_trade, "pk_bybit_trade", "bybit_trades"),
        _model("raw", bybit.sat_bybit_kline, "fk_bybit_kline", KLINES),
        _model("raw", bybit.sat_bybit_order, "fk_bybit_order", "bybit_orders"),
        _model("raw", bybit.sat_bybit_pnl, "fk_bybit_pnl", "bybit_pnl"),
        _model("raw", bybit.sat_bybit_trade, "fk_bybit_trade", "bybit_trades"),
        _model("raw", bybit.link_bybit_pnl_bybit_order, "fk_bybit_pnl", "bybit_pnl"),
        _model("raw", bybit.link_bybit_trade_bybit_order, "fk_bybit_trade", "bybit_trades"),
        _model("raw", kraken.hub_kraken_ohlc, "pk_kraken_ohlc", "kraken_ohlc_eur_usd"),
        _model("raw", kraken.hub_kraken_position, "pk_kraken_position", "kraken_positions"),
        _model("raw", kraken.hub_kraken_ticker, "pk_kraken_ticker", "kraken_tickers"),
        _model("raw", kraken.hub_kraken_transaction, "pk_kraken_transaction", "kraken_transactions"),
        _model("raw", kraken.sat_kraken_ohlc, "fk_kraken_ohlc", "kraken_ohlc_eur_usd"),
        _model("raw", kraken.sat_kraken_position, "fk_kraken_position", "kraken_positions"),
        _model("raw", kraken.sat_kraken_ticker, "fk_kraken_ticker", "kraken_tickers"),
        _model("raw", kraken.sat_kraken_transaction, "transaction_number", "kraken_transactions"),
        _model("business", business.calc_binance_accountbalance, None, "sat_binance_transaction"),
        _model(
            "business",
            business.calc_binance_transaction_accountbalance,
            "fk_binance_transaction",
            "sat_binance_transaction",
        ),
        _model(
            "business",
            _without_audit(business.calc_bybit_pnl_per_trade),
            "fk_bybit_trade",
            "sat_bybit_trade",
            "sat_bybit_kline",
        ),
        _model(
            "business",
            _without_audit(business.calc_kraken_pnl_per_trade),
            "fk_kraken_trade",
            "sat_kraken_position",
            "sat_kraken_ohlc",
        ),
        _model(
            "mart",
            marts.fact_binance_transaction,
            "transaction_at",
            "sat_binance_transaction",
            "calc_binance_transaction_accountbalance",
        ),
        _model("mart", marts.fact_bybit_trade, "trade_at", "calc_bybit_pnl_per_trade"),
    ]
)

# Key column of each hub; the quality checks want it unique and never NULL.
HUB_KEYS = {name: model.sort_by for name, model in MODELS.items() if name.startswith("hub_")}


def write_model(rows: DataFrame, name: str, env: str = "prod", default: str = "dev", **sizes: int) -> str:
    """Replace the table of a model, laid out as the model wants it; ``sizes`` go to :func:`write_layer`."""
    model = MODELS[name]
    bucket_by = model.sort_by if model.bucketed else None
    return write_layer(rows, model.layer, name, model.sort_by, env, default, model.unique_key, bucket_by, **sizes)


def build_tables(
    spark: SparkSession,
    read: Reader,
    names: Iterable[str] | None = None,
    env: str = "prod",
    default: str = "dev",
    run_id: str | None = None,
    normalise_keys: bool = False,
    group_rows: int = GROUP_ROWS,
    grid_bytes: int | None = GRID_BYTES,
    threads: int = 1,
) -> list[str]:
    """Rebuild the named models (all by default) as tables.

    ``read`` returns an export by name.  Models read the tables of the models
    ahead of them, which therefore have to exist.  ``normalise_keys``,
    ``group_rows`` and ``grid_bytes`` go to the models that know them.

    With ``threads`` so many models are built side by side; each waits for
    those it reads.  After a failure no further model is begun, and it raises
    once those under way have ended.
    """
    prepare(spark)
    run_id = run_id or new_run_id()
    wanted = set(MODELS if names is None else names)
    if unknown := wanted - set(MODELS):
        raise ValueError(f"no such model: {sorted(unknown)}")

    def table(name: str) -> DataFrame:
        if name in MODELS:
            return spark.table(table_name(MODELS[name].layer, name, env, default))
        return read(name)

    def build(name: str) -> str:
        model = MODELS[name]
        known = signature(model.build).parameters
        given = {"normalise_keys": normalise_keys, "group_rows": group_rows, "grid_bytes": grid_bytes}
        options = {option: value for option, value in given.items() if option in known}
        rows = model.build(*[table(t) for t in model.reads], run_id, **options)
        return write_model(rows, name, env, default)

    names = [name for name in MODELS if name in wanted]
    if threads <= 1:
        return [build(name) for name in names]
    for layer in {MODELS[name].layer for name in names}:  # not by several threads at once
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace(layer, env, default)}")
    return _side_by_side(names, build, threads)


def _side_by_side(names: list[str], build: Callable[[str], str], threads: int) -> list[str]:
    """Build models as soon as those they read are there."""
    waiting, running, done = list(names), {}, {}
    with ThreadPoolExecutor(threads) as pool:
        while waiting or running:
            for name in [n for n in waiting if not any(r in waiting or r in running.values() for r in MODELS[n].reads)]:
                if len(running) < threads:
                    waiting.remove(name)
                    running[pool.submit(build, name)] = name
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                done[running.pop(future)] = future.result()
    return [done[name] for name in names]


def check_tables(spark: SparkSession, env: str = "prod", default: str = "dev") -> DataFrame:
    """Failures of the key checks on the written hubs: two rows a hub, each table read once.

    The keys of a hub that lies by their hash are not moved; of one whose keys
    may repeat, they are combined ahead of the shuffle.
    """
    hubs = {name: (spark.table(table_name(MODELS[name].layer, name, env, default)), key) for name, key in HUB_KEYS.items()}
    return key_report(hubs)
