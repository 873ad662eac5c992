"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.operators.ordered import ordering


def total_order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    """``order`` followed by all other columns, so that no tie is left."""
    named = {name.removesuffix(" desc") for name in order} | set(keys)
    return [*order, *[c for c in df.columns if c not in named]]


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep the first row of each key by ``order``, such as ``["at desc"]``.

    Ties are decided by all other columns.  As only rank 1 survives, Spark
    drops the losers ahead of the shuffle (``WindowGroupLimit``): a key with
    very many copies reaches the final task as one row per input task.
    """
    window = Window.partitionBy(*keys).orderBy(*ordering(total_order(df, keys, order)))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
