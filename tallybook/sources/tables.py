"""Reading the exchange exports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    IntegralType,
    LongType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from tallybook.functions.decimals import from_text
from tallybook.session import prepare
from tallybook.sources.schemas import SCHEMAS

Reader = Callable[[str], DataFrame]


def lossless(column: str, found: DataType, declared: DataType) -> str | None:
    """SQL that gives a column its declared type without loss; None if there is no such way."""
    kind = declared.simpleString()
    whole_number = isinstance(found, IntegralType) or (isinstance(found, DecimalType) and found.scale == 0)
    if isinstance(found, TimestampNTZType) and isinstance(declared, TimestampType):
        return f"cast({column} as {kind})"
    if isinstance(declared, StringType) and isinstance(found, (IntegralType, DecimalType)):
        return f"cast({column} as {kind})"
    if isinstance(declared, LongType) and (whole_number or isinstance(found, StringType)):
        return f"cast({column} as {kind})"
    if isinstance(declared, DecimalType):
        if whole_number or (isinstance(found, DecimalType) and found.scale <= declared.scale):
            return f"cast({column} as {kind})"
        if isinstance(found, StringType):
            return from_text(column, declared.precision, declared.scale)
    return None


def conform(df: DataFrame, source: str) -> DataFrame:
    """Project to the declared columns and fail on a missing or foreign type.

    Only changes that lose nothing are made: a time without zone becomes the
    instant of the same UTC time; integers and decimals widen, or become text;
    epoch times and prices that come as text are parsed whole.  Malformed text,
    and a number too large for its type, raise when the rows are read.
    """
    types = {f.name: f.dataType for f in df.schema}
    columns = []
    for field in SCHEMAS[source]:
        found = types.get(field.name)
        if found is None:
            raise ValueError(f"{source}: column {field.name} is missing")
        column = F.col(f"`{field.name}`")
        if found != field.dataType:
            changed = lossless(f"`{field.name}`", found, field.dataType)
            if changed is None:
                raise ValueError(f"{source}.{field.name}: {found.simpleString()} is not {field.dataType.simpleString()}")
            column = F.expr(changed).alias(field.name)
        columns.append(column)
    return df.select(*columns)


def parquet_reader(spark: SparkSession, folder: str) -> Reader:
    """Read ``<folder>/<source>``, a parquet file or folder per export."""
    prepare(spark)
    return lambda source: conform(spark.read.parquet(f"{folder}/{source}"), source)


def table_reader(spark: SparkSession, namespace: str = "source") -> Reader:
    """Read ``<namespace>.<source>`` from the catalog."""
    prepare(spark)
    return lambda source: conform(spark.table(f"{namespace}.{source}"), source)
