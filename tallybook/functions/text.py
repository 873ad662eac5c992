"""Amount texts such as ``0.0010BTC``."""

from __future__ import annotations

# The patterns that decide which part of an amount text counts.
AMOUNT_PATTERN = r"(\d+).(\d+)"
COIN_PATTERN = r"[A-Z]+"

# The dot of AMOUNT_PATTERN matches any character, so a whole number loses its
# last digit or is not found at all.  This one reads whole numbers as well.
STRICT_AMOUNT_PATTERN = r"\d+(?:\.\d+)?"


def amount_text(x: str, strict: bool = False) -> str:
    """Digits of an amount text; empty if there are none, NULL for NULL."""
    return f"regexp_extract({x}, r'{STRICT_AMOUNT_PATTERN if strict else AMOUNT_PATTERN}', 0)"


def coin_text(x: str) -> str:
    """First run of capitals of an amount text; empty if there is none."""
    return f"regexp_extract({x}, r'{COIN_PATTERN}', 0)"


def snake(x: str) -> str:
    return f"lower(replace({x}, ' ', '_'))"
