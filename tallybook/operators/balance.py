"""Running account balances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tallybook.functions.decimals import add
from tallybook.operators.ordered import GROUP_ROWS, PART, Parts, arrange, cut_into_parts, match, ordering, parts_needed, scan

SUM = "decimal(37,8)"
SPAN, SPANS = "_span", ("day", "hour", "minute")


def running_balance(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    amount: str,
    out: str = "accountbalance",
    group_rows: int = GROUP_ROWS,
    sizes_from: DataFrame | None = None,
) -> DataFrame:
    """Sum of ``amount`` per account by time, larger amounts first.

    Rows with the same time and amount share one total, the one behind all of
    them.  ``sizes_from`` may name a cheaper table with at least as many rows
    per account, used only to tell whether an account is too large for one task.

    Large accounts are cut by the calendar, if a task takes what falls into a
    day, an hour or a minute: rows move once, and the sums of the spans ahead
    come along as one row each.  Else they are cut into parts between any two
    rows, also between rows that share a total: rows move once and are written
    out.  No row is joined back to its total: besides the sizes, and what the
    cuts need of accounts, times and amounts, rows are read once.
    """
    order = [at, f"{amount} desc"]
    parts = parts_needed(df if sizes_from is None else sizes_from, keys, group_rows)
    if not parts:
        window = Window.partitionBy(*keys).orderBy(*ordering(order))
        window = window.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.sum(amount).over(window).cast("decimal(37,8)").cast("decimal(38,8)"))

    if found := _span_needed(df, keys, at, group_rows):
        return _by_span(df, keys, at, amount, out, *found)

    laid = cut_into_parts(df, keys, order, parts, unique=False).withColumns(
        {"_step": F.col(amount).cast(SUM), "_known": F.col(amount).isNotNull().cast("bigint")}
    )
    peers = Window.partitionBy(*keys, PART).orderBy(*ordering(order))
    peers = peers.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    within = laid.withColumns({"_sum": F.sum("_step").over(peers).cast(SUM), "_count": F.sum("_known").over(peers)})
    joined = match(within, _carried(laid, keys, at, amount), [*keys, PART], "left", parts.entries)

    def plus(found: str, carried: str, beyond: str) -> str:
        at_the_end = f"{at} <=> _last.at and {amount} <=> _last.amount"
        return add(add(f"coalesce({found}, 0)", f"coalesce({carried}, 0)", 8), f"if({at_the_end}, coalesce({beyond}, 0), 0)", 8)

    known = f"_count + coalesce(_carried_count, 0) + if({at} <=> _last.at and {amount} <=> _last.amount, coalesce(_beyond_count, 0), 0)"
    total = f"cast({plus('_sum', '_carried_sum', '_beyond_sum')} as decimal(38,8))"
    return joined.selectExpr(*[f"`{c}`" for c in df.columns], f"if({known} > 0, {total}, null) as {out}")


def _span_needed(df: DataFrame, keys: Sequence[str], at: str, group_rows: int) -> tuple[str, Parts | None] | None:
    """The longest span of time of which each account has no more rows than a part may hold, and how to cut the spans.

    None if there is no such span, or if spans would be no fewer than a tenth of the rows.
    """
    if not isinstance(df.schema[at].dataType, (TimestampType, TimestampNTZType)):
        return None
    for unit in SPANS:
        span = f"date_trunc('{unit}', {at})"
        sizes = df.groupBy(*keys, F.expr(span).alias(SPAN)).agg(F.count(F.lit(1)).alias("_rows"))
        accounts = sizes.groupBy(*keys).agg(F.max("_rows").alias("_most"), F.count(F.lit(1)).alias("_spans"), F.sum("_rows").alias("_rows"))
        most, longest, spans, rows, groups = accounts.agg(
            F.max("_most"), F.max("_spans"), F.sum("_spans"), F.sum("_rows"), F.count(F.lit(1))
        ).first()
        if 10 * spans > rows:
            return None
        # Small parts grow rather than become very many, and so may what falls into a span.
        if most <= max(group_rows, Parts.of(rows, groups, group_rows).size(rows)):
            return span, Parts.of(spans, groups, group_rows) if longest > group_rows else None
    return None


def _by_span(
    df: DataFrame, keys: Sequence[str], at: str, amount: str, out: str, span: str, parts: Parts | None
) -> DataFrame:
    """Balances within a span of time, on top of one row with the sums of the account's spans ahead."""
    spanned = df.withColumn(SPAN, F.expr(span))
    sums = spanned.groupBy(*keys, SPAN).agg(F.sum(amount).cast(SUM).alias("_step"), F.count(amount).alias("_known"))
    carry = {"_ahead": ("_step", SUM), "_known_ahead": ("_known", "bigint")}
    ahead = scan(arrange(sums, keys, [SPAN], parts), keys, [SPAN], carry, parts=parts)
    # Those of a first span carry nothing, but NULL tells the rows from them.
    together = spanned.unionByName(ahead.select(*keys, SPAN, *carry), allowMissingColumns=True)
    placed = together.repartition(*keys, SPAN).withColumns(
        {
            "_row": F.col("_known_ahead").isNull(),
            "_step": F.coalesce("_ahead", F.col(amount).cast(SUM)),
            "_known": F.coalesce("_known_ahead", F.col(amount).isNotNull().cast("bigint")),
        }
    )
    upto = Window.partitionBy(*keys, SPAN).orderBy("_row", *ordering([at, f"{amount} desc"]))
    upto = upto.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    totals = placed.withColumns({"_sum": F.sum("_step").over(upto).cast(SUM), "_count": F.sum("_known").over(upto)})
    total = f"if(_count > 0, cast(_sum as decimal(38,8)), null) as {out}"
    return totals.filter("_row").selectExpr(*[f"`{c}`" for c in df.columns], total)


def _carried(laid: DataFrame, keys: Sequence[str], at: str, amount: str) -> DataFrame:
    """One row per key and part: sums of the parts ahead, and what later parts add to the part's last peers.

    Rows of one time and amount are peers and share a total.  Peers may go on
    in the next parts; only a part's first and last peers may have others
    elsewhere, so two small rows per part settle it.
    """
    groups = [*keys, PART]
    peers = laid.groupBy(*groups, at, amount).agg(F.sum("_step").alias("_step"), F.sum("_known").alias("_known"))
    place = F.struct(F.col(at).isNull(), F.col(at), F.col(amount).isNull(), -F.col(amount))
    peer = F.struct(F.col(at).alias("at"), F.col(amount).alias("amount"), "_step", "_known")
    ends = peers.groupBy(*groups).agg(
        F.sum("_step").cast(SUM).alias("_sum"),
        F.sum("_known").alias("_count"),
        F.min_by(peer, place).alias("_first"),
        F.max_by(peer, place).alias("_last"),
    )
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    placed = ends.withColumns(
        {"_carried_sum": F.sum("_sum").over(earlier).cast(SUM), "_carried_count": F.sum("_count").over(earlier)}
    )
    edges = placed.withColumn("_edge", F.explode(F.array_distinct(F.array("_first", "_last"))))
    later = Window.partitionBy(*keys, "_edge.at", "_edge.amount").orderBy(F.col(PART).desc())
    later = later.rowsBetween(Window.unboundedPreceding, -1)
    beyond = edges.withColumns(
        {
            "_beyond_sum": F.sum("_edge._step").over(later).cast(SUM),
            "_beyond_count": F.sum("_edge._known").over(later),
        }
    )
    return beyond.filter("_edge <=> _last").drop("_sum", "_count", "_first", "_edge")
