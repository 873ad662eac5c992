"""Run a query and its SQL side by side and compare the rows."""

from __future__ import annotations

import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from parity.catalog import QUERIES
from parity.oracles import ORACLES


def _plain(value):
    return format(value.normalize(), "f") if isinstance(value, Decimal) else value


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def compare(spark: SparkSession, connection: duckdb.DuckDBPyConnection, folder: str, name: str) -> dict:
    """Row counts, names and types of both sides, and the rows only one has."""
    started = time.time()
    df = QUERIES[name](spark, folder)
    ours = df.toArrow()
    took = time.time() - started
    theirs = connection.sql(ORACLES[name]).to_arrow_table()
    mine = _bag(ours.column_names, zip(*[c.to_pylist() for c in ours.columns], strict=True))
    other = _bag(theirs.column_names, zip(*[c.to_pylist() for c in theirs.columns], strict=True))
    types = {f.name: str(f.type) for f in ours.schema}
    expected = {f.name: str(f.type) for f in theirs.schema}
    return {
        "rows": ours.num_rows,
        "expected_rows": theirs.num_rows,
        "names_differ": sorted(set(ours.column_names) ^ set(theirs.column_names)),
        "types_differ": {n: (types[n], expected.get(n)) for n in types if types[n] != expected.get(n)},
        "only_ours": list((mine - other).items())[:3],
        "only_expected": list((other - mine).items())[:3],
        "seconds": round(took, 2),
    }
