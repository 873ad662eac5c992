"""Key texts, hashed keys and audit columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_text(*parts: str) -> str:
    """Join parts with ``_``; NULL as soon as one part is NULL.

    ``concat_ws`` is no substitute, because it skips NULL parts and would give
    different records the same key.
    """
    joined = ", '_', ".join(parts)
    return f"concat({joined})"


def hashed(text: str) -> str:
    """Lower-case hexadecimal MD5 of a key text."""
    return f"md5({text})"


def new_run_id() -> str:
    return str(uuid.uuid4())


def with_audit(df: DataFrame, run_id: str, after: int = 1) -> DataFrame:
    """Say which run wrote a row and when, behind the first ``after`` columns."""
    names = [F.col(f"`{name}`") for name in df.columns]
    audit = [
        F.lit(run_id).alias("record_source"),
        F.date_trunc("second", F.current_timestamp()).alias("load_dts"),
    ]
    return df.select(*names[:after], *audit, *names[after:])
