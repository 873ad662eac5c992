"""Signed positions and what each trade does to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.operators.ordered import Parts, scan

# A quantity, and a sum of quantities.
QUANTITY, RUNNING = "decimal(18,4)", "decimal(28,4)"


def signed_quantity(side: str = "side", execution_type: str = "execution_type", quantity: str = "quantity") -> str:
    """Bought quantities count up, sold ones down, everything else is 0."""
    sign = f"case {side} when 'Buy' then {quantity} when 'Sell' then -{quantity} else 0 end"
    return f"cast(if({execution_type} = 'Trade', {sign}, 0) as {QUANTITY})"


def position_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    parts: Parts | None = None,
    quantity: str = "quantity",
    out: str = "held_before",
) -> DataFrame:
    """Position held ahead of each trade."""
    return scan(df, keys, order, {out: (quantity, RUNNING)}, parts=parts)


def with_legs(df: DataFrame, net: str = "held_before", quantity: str = "quantity") -> DataFrame:
    """Add the ``_closed`` and ``_opened`` quantity of each trade and the books.

    A trade against the position closes as much of it as there is; whatever is
    left of the trade opens.  The book closed is the side held, the book opened
    the side of the trade.
    """
    closed = f"""case when {net} > 0 and {quantity} < 0 then least({net}, -{quantity})
        when {net} < 0 and {quantity} > 0 then least(-{net}, {quantity}) else 0 end"""
    return df.selectExpr(
        "*",
        f"if({net} > 0, 'long', 'short') as _closed_book",
        f"if({quantity} > 0, 'long', 'short') as _opened_book",
        f"cast({closed} as {QUANTITY}) as _closed",
    ).selectExpr("*", f"cast(abs({quantity}) - _closed as {QUANTITY}) as _opened")


def split_legs(df: DataFrame, carry: Sequence[str]) -> DataFrame:
    """One row per leg with ``leg`` and ``units``; a flip gives two.

    The rows are read once and unfolded, not once per kind of leg.
    """
    legs = """inline(array(
        struct(concat(_closed_book, '_close') as leg, _closed as units),
        struct(concat(_opened_book, '_open') as leg, _opened as units)))"""
    return with_legs(df).selectExpr(*carry, legs).filter(F.col("units") > 0)
