"""Helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A table that may be broadcast has at most so many rows, of a few numbers each, and so many bytes in arrays.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``value`` computed once a row and named ``name``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def quoted(pattern: str) -> str:
    """A pattern as it stands inside an SQL literal."""
    return pattern.replace("\\", "\\\\")


def grams_of(words: str, length: int) -> str:
    """SQL for the hashes of all grams of ``length`` words; empty if there are fewer words."""
    parts = ", ".join(f"get(h, i + {j})" for j in range(length))
    grams = f"if(size(h) < {length}, array(), transform(sequence(0, size(h) - {length}), i -> xxhash64({parts})))"
    return let(f"transform({words}, w -> xxhash64(w))", "h", grams)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def settled(df: DataFrame) -> DataFrame:
    """Rows written to the shared folder, so that a lost executor does not recompute them."""
    return cut_lineage(df)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, held: Column | None = None) -> DataFrame:
    """Mark a settled table for broadcasting if it is counted to be small.

    ``held`` gives the bytes of what a row holds besides a few numbers; their
    sum is bounded as well.
    """
    if held is None:
        return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
    counted, size = df.agg(F.count("*"), F.coalesce(F.sum(held), F.lit(0))).first()
    return F.broadcast(df) if counted <= rows and size <= BROADCAST_BYTES else df
