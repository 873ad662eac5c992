"""Exchange rates by the minute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions import decimals, times
from tallybook.session import cut_lineage

DAY_MINUTES = 1_440
RATE_BYTES = 8  # of a rate in an array
GRID_BYTES = 64 << 20  # of a grid, at most: some fifteen years

def rates_by_minute(candles: DataFrame, at: str, close: str = "close_price") -> DataFrame:
    """The closing rate of each candle, cut to four digits."""
    return candles.selectExpr(f"{at} as _rate_at", f"{decimals.rate(close)} as fx_rate")


def fx_at_minute(rows: DataFrame, rates: DataFrame, at: str) -> DataFrame:
    """Add ``fx_rate`` of the row's minute; rows of a minute without rate go.

    ``rates`` comes from :func:`rates_by_minute`.  Whether it is broadcast is
    left to the session's threshold and to adaptive execution, which also
    splits minutes with very many trades in a shuffled join.
    """
    return rows.join(rates, F.expr(f"{times.minute(at)} = _rate_at"), "inner").drop("_rate_at")


def minute_grid(rates: DataFrame, max_bytes: int = GRID_BYTES) -> DataFrame | None:
    """One row a day, ``_day`` and ``_rates``: the rates of its 1,440 minutes, NULL for a gap.

    None if the days are too many for ``max_bytes``, or if a minute has several
    rates (then each gives a row, which an array by minute cannot).  The grid is
    written out; only its size comes to the driver.
    """
    minutes = rates.filter(f"_rate_at = {times.minute('_rate_at')} and fx_rate is not null").selectExpr(
        "to_date(_rate_at) as _day", "hour(_rate_at) * 60 + minute(_rate_at) as _minute", "fx_rate"
    )
    found = minutes.groupBy("_day", "_minute").agg(F.min("fx_rate").alias("fx_rate"), F.count(F.lit(1)).alias("_times"))
    found = cut_lineage(found)
    days, most = found.agg(F.countDistinct("_day"), F.max("_times")).first()
    if days * DAY_MINUTES * RATE_BYTES > max_bytes or (most or 1) > 1:
        return None
    gaps = found.select("_day").distinct().selectExpr("_day", f"explode(sequence(0, {DAY_MINUTES - 1})) as _minute")
    filled = gaps.join(found, ["_day", "_minute"], "left")
    by_minute = filled.groupBy("_day").agg(F.sort_array(F.collect_list(F.struct("_minute", "fx_rate"))).alias("_rates"))
    return cut_lineage(by_minute.selectExpr("_day", "transform(_rates, x -> x.fx_rate) as _rates"))


def fx_from_grid(rows: DataFrame, grid: DataFrame, at: str) -> DataFrame:
    """The same as :func:`fx_at_minute` from a grid, which is broadcast whatever the session's threshold.

    Rows find their day by a hash join and their minute by its place, so they
    are not moved, and no minute with very many of them is a bottleneck.
    """
    by_day = rows.join(F.broadcast(grid), F.expr(f"to_date({at}) = _day"), "inner")
    rated = by_day.withColumn("fx_rate", F.expr(f"_rates[hour({at}) * 60 + minute({at})]"))
    return rated.filter("fx_rate is not null").drop("_day", "_rates")


def rated(rows: DataFrame, rates: DataFrame, at: str, grid_bytes: int | None = None) -> DataFrame:
    """Rows with the rate of their minute: from a grid if one of ``grid_bytes`` can be made, else by a join."""
    grid = minute_grid(rates, grid_bytes) if grid_bytes else None
    return fx_at_minute(rows, rates, at) if grid is None else fx_from_grid(rows, grid, at)


def without_rate(rows: DataFrame, rates: DataFrame, at: str) -> DataFrame:
    """The rows that :func:`fx_at_minute` drops."""
    return rows.join(rates, F.expr(f"{times.minute(at)} = _rate_at"), "left_anti")


def multiplied(amount: str, rate: str = "fx_rate") -> str:
    """Amount at a rate that says what one unit of it is worth."""
    return f"({amount} * {rate})"


def divided(amount: str, rate: str = "fx_rate") -> str:
    """Amount at a rate that says how much of it one unit costs."""
    return decimals.quotient(amount, rate)
