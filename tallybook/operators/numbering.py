"""Occurrence numbers: telling apart records that share a natural key."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.operators.dedup import total_order
from tallybook.operators.ordered import GROUP_ROWS, Parts, cut_into_parts, large_groups, match, ordering, scan
from tallybook.session import cut_lineage

CHUNK_ROWS = 100_000
TASK_ROWS = 1_000_000  # emitted by a task, about


def repeat_rows(
    df: DataFrame,
    times: str,
    index: str,
    chunk_rows: int = CHUNK_ROWS,
    most: int | None = None,
    total: int | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Emit each row ``times`` times, with ``index`` running from 1.

    A row to be repeated more than ``chunk_rows`` times is first cut into
    chunks that are spread over the cluster.  That reads ``df`` twice; ``most``,
    the largest number of times if known, may tell that there is no such row.

    Few rows may become very many, and Spark would put few rows into few tasks.
    With ``total``, the number of rows emitted, all chunks are dealt to as many
    tasks as that takes, and ``df`` is read once.
    """
    n = F.col(times)
    if total is not None and total > task_rows:
        first = F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1, F.lit(chunk_rows).cast("bigint")))
        each = F.explode(F.sequence(F.col("_start") + 1, F.least(n, F.col("_start") + chunk_rows)))
        chunks = df.withColumn("_start", first).repartition(math.ceil(total / task_rows), "_start", *df.columns)
        return chunks.withColumn(index, each).drop("_start", times)
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), n))
    if most is not None and most <= chunk_rows:
        return df.withColumn(index, each).drop(times)
    few = df.filter(n <= chunk_rows).withColumn(index, each)
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1, F.lit(chunk_rows).cast("bigint")))
    many = (
        df.filter(n > chunk_rows)
        .withColumn("_start", start)
        .repartition("_start", *[c for c in df.columns])
        .withColumn(index, F.explode(F.sequence(F.col("_start") + 1, F.least(n, F.col("_start") + chunk_rows))))
        .drop("_start")
    )
    return few.unionByName(many).drop(times)


def occurrences(
    df: DataFrame,
    keys: Sequence[str],
    out: str = "r",
    chunk_rows: int = CHUNK_ROWS,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Keys with occurrence numbers 1, 2, ...; nothing else of the rows.

    A hub only needs to know how often a natural key occurs, so counting
    (combined on the map side) replaces ranking the rows.  A bare count tells
    over how many tasks the numbers are spread.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times"))
    return repeat_rows(counts, "_times", out, chunk_rows, total=df.count(), task_rows=task_rows)


def number_occurrences(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "r", group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Number the rows of each natural key by ``order``.

    Ties are decided by all other columns, so which row gets which number does
    not depend on the run.  Natural keys with more than ``group_rows`` rows are
    numbered across tasks; only they pay for it.
    """
    ranking = total_order(df, keys, order)
    window = Window.partitionBy(*keys).orderBy(*ordering(ranking))

    def ranked(rows: DataFrame) -> DataFrame:
        return rows.withColumn(out, F.row_number().over(window).cast("bigint"))

    # A bare count reads no columns; a small table needs no look at its keys.
    rows = df.count()
    if rows <= group_rows:
        return ranked(df)
    large = cut_lineage(large_groups(df, keys, group_rows))
    rows_in_large, largest, groups = large.agg(F.sum("_size"), F.max("_size"), F.count(F.lit(1))).first()
    if not groups:
        return ranked(df)

    large, all_large = large.drop("_size"), rows_in_large == rows
    # Identical rows are interchangeable: number one of them with its weight.
    copied = df if all_large else match(df, large, keys, "left_semi", groups)
    distinct = copied.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_times"))
    parts = Parts.of(rows_in_large, groups, group_rows)
    laid = cut_into_parts(distinct, keys, ranking, parts)
    most = largest if largest <= CHUNK_ROWS else laid.agg(F.max("_times")).first()[0]
    placed = scan(laid, keys, ranking, sums={"_ahead": ("_times", "bigint")}, parts=parts)
    spread = repeat_rows(placed.select(*df.columns, "_ahead", "_times"), "_times", "_index", most=most)
    numbered = spread.withColumn(out, F.col("_ahead") + F.col("_index")).select(*df.columns, out)
    if all_large:
        return numbered
    return ranked(match(df, large, keys, "left_anti", groups)).unionByName(numbered)
