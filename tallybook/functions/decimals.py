"""Exact decimals that drop surplus digits instead of rounding them.

A Spark decimal cast rounds half up.  Ledger amounts must be cut towards zero,
so every conversion here removes the surplus digits before the cast.
"""

from __future__ import annotations

CASTS = {"raise": "cast", "null": "try_cast"}


def cut(x: str, precision: int, scale: int, on_error: str = "raise") -> str:
    """Number to decimal, surplus digits dropped."""
    cast = CASTS[on_error]
    wide = f"{cast}({x} as decimal(38,18))"
    unit = f"cast('1e-{scale}' as decimal({scale + 1},{scale}))"
    return f"{cast}({wide} - {wide} % {unit} as decimal({precision},{scale}))"


NUMBER = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)"
AROUND = "[\\\\x00-\\\\x20]*"  # what a cast strips
EXPONENT = "[eE][+-]?[0-9]+"
LARGEST_EXPONENT = 100  # beyond every decimal type


def _whole(x: str, pattern: str) -> str:
    return f"{x} rlike '^{AROUND}{pattern}{AROUND}$'"


def _shortened(x: str, scale: int) -> str:
    """Plain notation without the digits behind ``scale``."""
    return f"if(instr({x}, '.') > 0, substring({x}, 1, instr({x}, '.') + {scale}), {x})"


def _plain(x: str, scale: int) -> str:
    """Text with an exponent in plain notation, without the digits behind ``scale``.

    Its point is moved in the text, so no digit is lost: the digits stand
    between zeros enough for any exponent, and the point is set among them.
    """

    def part(pattern: str) -> str:
        return f"regexp_extract({x}, '{pattern}', 1)"

    whole, behind = part("([0-9]*)[.]?[0-9]*[eE]"), part("[.]([0-9]*)[eE]")
    beyond = f"if({x} rlike '[eE]-', -{LARGEST_EXPONENT}, {LARGEST_EXPONENT})"
    power = f"coalesce(try_cast({part('[eE]([+-]?[0-9]+)')} as int), {beyond})"
    zeros = f"repeat('0', {LARGEST_EXPONENT})"
    digits = f"concat({zeros}, {whole}, {behind}, {zeros})"
    point = f"({LARGEST_EXPONENT} + length({whole}) + greatest(-{LARGEST_EXPONENT}, least({LARGEST_EXPONENT}, {power})))"
    sign = part("^[^0-9.]*([-])")
    return f"concat({sign}, substring({digits}, 1, {point}), '.', substring({digits}, {point} + 1, {scale}))"


def from_text(x: str, precision: int, scale: int, on_error: str = "raise") -> str:
    """Decimal from text, surplus digits dropped.

    The whole text must be a number, with or without an exponent; only then is
    it shortened, as text, which is exact for any number of digits.  Malformed
    text raises, or gives NULL with ``on_error='null'``.
    """
    cast, kind = CASTS[on_error], f"decimal({precision},{scale})"
    return (
        f"case when {_whole(x, NUMBER)} then {cast}({_shortened(x, scale)} as {kind}) "
        f"when {_whole(x, NUMBER + EXPONENT)} then {cast}({_plain(x, scale)} as {kind}) "
        f"else {cast}(concat('not a number: ', {x}) as {kind}) end"
    )


def money(x: str, on_error: str = "raise") -> str:
    """The usual measure type: 18 digits, 8 of them after the point."""
    return from_text(x, 18, 8, on_error)


def rate(x: str) -> str:
    """Exchange rate as used in conversions: cut to four digits."""
    return cut(x, 9, 4)


def quotient(amount: str, divisor: str) -> str:
    """Decimal division that keeps eight digits and drops the rest.

    Spark rounds the 18th digit of ``decimal(18,8) / decimal(9,4)``; a divisor
    below 10^9 units cannot produce ten nines there, so the cut is exact.
    """
    return cut(f"(cast({amount} as decimal(18,8)) / cast({divisor} as decimal(9,4)))", 18, 8)


def add(a: str, b: str, scale: int) -> str:
    """Sum of two wide decimals without losing a digit of scale."""
    kind = f"decimal(37,{scale})"
    return f"cast(cast({a} as {kind}) + cast({b} as {kind}) as decimal(38,{scale}))"


def subtract(a: str, b: str, scale: int) -> str:
    """Difference of two wide decimals without losing a digit of scale."""
    kind = f"decimal(37,{scale})"
    return f"cast(cast({a} as {kind}) - cast({b} as {kind}) as decimal(38,{scale}))"
