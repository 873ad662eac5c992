"""First-in first-out matching of closing with opening trades.

Opened quantities of a book, laid end to end, form an axis; so do the closed
ones, and a close is served by the lots that lie at the same place.  Let
``V(x)`` be what the first ``x`` units opened are worth.  A close that takes
the units from ``a`` to ``b`` has the cost ``V(b) - V(a)``, whatever number of
lots it touches.  ``V(b)`` is the worth of all lots that start ahead of ``b``
less the part of the last one behind ``b``.  So a close needs a running sum, one
lot, and the close before it; no lot is paired with every close.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallybook.functions.decimals import subtract
from tallybook.operators.ordered import GROUP_ROWS, Parts, cut_into_parts, parts_needed, scan
from tallybook.operators.position import QUANTITY, RUNNING, position_before, with_legs


@dataclass(frozen=True)
class Valuation:
    """A profit column and the price it is computed from.

    ``scale`` is that of price times quantity.  With four digits of quantity
    the product fits into 38 digits without rounding.
    """

    result: str
    price: str
    price_type: str
    scale: int

    def worth(self, price: str, quantity: str) -> str:
        product = f"cast({price} as {self.price_type}) * cast({quantity} as decimal(18,4))"
        return f"cast({product} as decimal(38,{self.scale}))"


VALUATIONS = [
    Valuation("realized_pnl", "price", "decimal(18,8)", 12),
    Valuation("realized_pnl_eur", "price_eur", "decimal(19,12)", 16),
]
PNL_COLUMNS = [v.result for v in VALUATIONS]

CLOSE, OPEN, NEITHER = 0, 1, 2
NO_BOOK = "'none'"


def on_axis(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: Parts | None = None) -> DataFrame:
    """Place trades with ``held_before`` on the axis of the book they change.

    A trade that closes lies where its closed quantity ends, one that opens
    where its lot begins.  A flip gives a second row for its lot; exactly one
    row per trade has ``_reported``.
    """
    carry = [c for c in df.columns if c not in ("held_before", "_part")]
    opened = {
        f"_{book}_ahead": (f"if(_opened_book = '{book}', _opened, 0)", RUNNING) for book in ("long", "short")
    }
    placed = scan(with_legs(df), keys, order, opened, parts=parts)

    def ahead(book: str) -> str:
        return f"if({book} = 'long', _long_ahead, _short_ahead)"

    def by_kind(close: str, opening: str, neither: str) -> str:
        return f"case _kind when {CLOSE} then {close} when {OPEN} then {opening} else {neither} end"

    # Closed so far = opened so far less what is still held.
    closed_up_to = f"{ahead('_closed_book')} - (abs(held_before) - _closed)"
    flip = "_closed > 0 and _opened > 0"
    kind = f"case when _closed > 0 and _leg = 0 then {CLOSE} when _opened > 0 then {OPEN} else {NEITHER} end"
    return (
        placed.selectExpr("*", f"explode(if({flip}, array(0, 1), array(0))) as _leg")
        .selectExpr("*", f"{kind} as _kind")
        .selectExpr(
            *carry,
            "_kind",
            f"{by_kind('_closed_book', '_opened_book', NO_BOOK)} as _book",
            f"cast({by_kind(closed_up_to, ahead('_opened_book'), '0')} as {RUNNING}) as _place",
            f"cast({by_kind('_closed', '_opened', '0')} as {QUANTITY}) as _qty",
            "_leg = 0 as _reported",
        )
    )


def realise(axis: DataFrame, keys: Sequence[str], unique: str, parts: Parts | None = None) -> DataFrame:
    """Realised profit of every row on the axis, 0 unless it closes."""
    order = ["_place", "_kind", unique]
    is_open, is_close = f"_kind = {OPEN}", f"_kind = {CLOSE}"

    # At one place closes come ahead of opens: the lots summed up, and the last
    # of them, all start ahead of the place where a close ends.
    worth = {
        f"_{v.result}_ahead": (f"if({is_open}, {v.worth(v.price, '_qty')}, null)", f"decimal(37,{v.scale})")
        for v in VALUATIONS
    }
    prices = ", ".join(f"{v.price} as {v.price}" for v in VALUATIONS)
    lot = f"if({is_open}, struct(cast(_place + _qty as {RUNNING}) as stop, {prices}), null)"
    served = scan(axis, keys, order, worth, {"_lot": lot}, parts)

    behind = {v: v.worth(f"_lot.{v.price}", "_lot.stop - _place") for v in VALUATIONS}
    costs = ", ".join(f"{subtract(f'_{v.result}_ahead', behind[v], v.scale)} as {v.result}" for v in VALUATIONS)
    used = [c for c in served.columns if c != "_lot" and not c.endswith("_ahead")]
    served = served.selectExpr(*used, f"if({is_close}, struct({costs}), null) as _cost")
    served = scan(served, keys, order, seen={"_cost_ahead": "_cost"}, parts=parts)

    def profit(v: Valuation) -> str:
        zero = f"cast(0 as decimal(38,{v.scale}))"
        taken = v.worth(v.price, "_qty")
        cost = subtract(f"_cost.{v.result}", f"coalesce(_cost_ahead.{v.result}, {zero})", v.scale)
        gain = f"if(_book = 'long', {subtract(taken, cost, v.scale)}, {subtract(cost, taken, v.scale)})"
        # Trades without a symbol are a group to a window, but share no book.
        return f"if({is_close} and {keys[0]} is not null, {gain}, {zero}) as {v.result}"

    return served.selectExpr("*", *[profit(v) for v in VALUATIONS])


def _placed(
    trades: DataFrame, symbol: str, order: Sequence[str], group_rows: int, sizes_from: DataFrame | None
) -> tuple[DataFrame, list[str], Parts | None]:
    """Trades on the axes of their books, the columns that make a book, and how the rows are cut."""
    parts = parts_needed(trades if sizes_from is None else sizes_from, [symbol], group_rows)
    # The ledger is written out twice, once in either order.  The samples for the
    # range boundaries run what lies behind the last shuffle once more, no more than that.
    if parts:
        trades = cut_into_parts(trades, [symbol], order, parts)
    axis = on_axis(position_before(trades, [symbol], order, parts), [symbol], order, parts)

    book = [symbol, "_book"]
    if parts:
        # A flip adds a row, so there are at most twice as many rows.
        parts = parts.times(rows=2, keys=3)
        axis = cut_into_parts(axis, book, ["_place", "_kind", order[-1]], parts)
    return axis, book, parts


def fifo_profit(
    trades: DataFrame,
    symbol: str = "symbol",
    at: str = "trade_at",
    unique: str = "fk_bybit_trade",
    group_rows: int = GROUP_ROWS,
    sizes_from: DataFrame | None = None,
) -> DataFrame:
    """Add the realised profit, in both currencies, to each trade.

    ``trades`` needs signed ``quantity``, ``price`` and ``price_eur``.  Trades
    of one symbol are ordered by ``at``, within a second by ``unique``; trades
    without a symbol have a profit of 0.

    ``sizes_from`` may name a cheaper table with at least as many rows per
    symbol, used only to tell whether a symbol is too large for one task.
    """
    axis, book, parts = _placed(trades, symbol, [at, unique], group_rows, sizes_from)
    return realise(axis, book, unique, parts).filter("_reported").select(*trades.columns, *PNL_COLUMNS)


def fifo_lots(
    trades: DataFrame,
    symbol: str = "symbol",
    at: str = "trade_at",
    unique: str = "fk_bybit_trade",
    group_rows: int = GROUP_ROWS,
    sizes_from: DataFrame | None = None,
) -> DataFrame:
    """Which lot paid for which close: one row per close and lot that overlap.

    Closes and lots both cut the axis of a book, and between two neighbouring
    cuts there is one lot and one close.  So each row of the axis gives at most
    one segment, from the cut ahead of it up to its own place: it belongs to the
    last lot that starts ahead, and to the close itself or the next one to come.
    There are at most as many segments as trades and flips, and no lot is paired
    with the closes it might serve.

    Columns: symbol, book, ``unique`` of the close as ``closed_by`` and of the
    opening trade as ``opened_by``, their times, the units they share, both
    prices in both currencies, and the profit of the segment in both.  The
    profits of a close's segments add up to what :func:`fifo_profit` gives it.
    Units still held have no row, nor have trades without a symbol.
    """
    axis, book, parts = _placed(trades, symbol, [at, unique], group_rows, sizes_from)
    prices = ", ".join(v.price for v in VALUATIONS)

    def trade(kind: int) -> str:
        return f"if(_kind = {kind}, struct({unique} as trade, {at} as at, {prices}), null)"

    used = axis.filter(f"_kind <> {NEITHER} and {symbol} is not null")
    seen, coming = {"_from": "_place", "_lot": trade(OPEN)}, {"_next": trade(CLOSE)}
    segments = scan(used, book, ["_place", "_kind", unique], seen=seen, coming=coming, parts=parts)
    owned = segments.selectExpr(
        f"{symbol} as symbol",
        "_book as book",
        "_lot",
        f"coalesce({trade(CLOSE)}, _next) as _close",
        f"cast(_place - _from as {QUANTITY}) as units",
    ).filter("units > 0 and _lot is not null and _close is not null")

    def gain(v: Valuation) -> str:
        taken, cost = v.worth(f"_close.{v.price}", "units"), v.worth(f"_lot.{v.price}", "units")
        return f"if(book = 'long', {subtract(taken, cost, v.scale)}, {subtract(cost, taken, v.scale)}) as {v.result}"

    return owned.selectExpr(
        "symbol",
        "book",
        "_close.trade as closed_by",
        "_lot.trade as opened_by",
        "_close.at as closed_at",
        "_lot.at as opened_at",
        "units",
        *[f"_close.{v.price} as close_{v.price}" for v in VALUATIONS],
        *[f"_lot.{v.price} as open_{v.price}" for v in VALUATIONS],
        *[gain(v) for v in VALUATIONS],
    )
