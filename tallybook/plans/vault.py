"""Builders of hubs, satellites and links.

Key texts and attributes are SQL expressions over the given rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybook.functions.keys import hashed, with_audit


def named(expressions: dict[str, str]) -> list[str]:
    return [f"{sql} as `{name}`" for name, sql in expressions.items()]


def hub(df: DataFrame, text: str, key: str, business_key: str, run_id: str) -> DataFrame:
    """Hashed key, business key and audit columns."""
    return with_audit(df.selectExpr(*named({key: hashed(text), business_key: text})), run_id, after=2)


def satellite(df: DataFrame, text: str, key: str, attributes: dict[str, str], run_id: str) -> DataFrame:
    """Hashed key of the record described, audit columns and attributes."""
    return with_audit(df.selectExpr(*named({key: hashed(text)} | attributes)), run_id)


def link(df: DataFrame, own: tuple[str, str], ends: dict[str, str], run_id: str) -> DataFrame:
    """Own hashed key and the hashed keys of the two records it connects."""
    name, text = own
    keys = {name: hashed(text)} | {end: hashed(t) for end, t in ends.items()}
    return with_audit(df.selectExpr(*named(keys)), run_id, after=len(keys))
