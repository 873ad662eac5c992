"""Quality checks: each returns the offending rows, none if all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number; NULL is exempt."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter(F.col("n_records") > 1)


def key_report(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Failures of both checks for each named table and its key column.

    Each table is read once: both counts come from the records per key.
    """

    def lines(name: str, df: DataFrame, column: str) -> DataFrame:
        key = F.col(column)
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        missing = F.sum(F.when(key.isNull(), F.col("n")).otherwise(0))
        repeated = F.count(F.when(key.isNotNull() & (F.col("n") > 1), 1))
        found = per_key.agg(F.coalesce(missing, F.lit(0)).alias("missing"), repeated.alias("repeated"))
        checks = [
            F.struct(F.lit(check).alias("check_name"), F.col(count).alias("failures"))
            for check, count in (("not_null", "missing"), ("unique", "repeated"))
        ]
        return found.select(F.lit(name).alias("model"), F.lit(column).alias("column_name"), F.inline(F.array(*checks)))

    return reduce(DataFrame.unionByName, [lines(name, df, column) for name, (df, column) in tables.items()])
