"""Running sums and carried values over groups of any size.

A Spark window sorts a whole group in one task.  That is fine for groups of up
to ``GROUP_ROWS`` rows; a symbol or an account that holds a third of a large
ledger needs more than one task.  Such groups are cut into *parts*: stretches
of consecutive rows, found by Spark's own range partitioning.  A window then
runs within each part, and one small row per part carries the state over to
the parts behind it.  The number of these rows depends on the number of parts,
not on the data in them.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.session import cut_lineage_in_place

GROUP_ROWS = 2_000_000
PART = "_part"

# Spark samples a million rows at most to find range boundaries: beyond this
# many parts their sizes would become uneven.
MAX_PARTS = 50_000

# Rows sampled for each part where boundaries are drawn ahead, and in all; Spark takes as many for its own.
SAMPLED_ROWS, MAX_SAMPLED_ROWS = 100, 1_000_000
# To the microsecond, for times among the boundaries.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

# Each part is a task, and adds some hundred sampled rows and a task's result to what
# the driver gets.  Below ``GROUP_ROWS`` parts grow rather than become more than this.
MAX_SMALL_PARTS = 256

# Largest table of keys or parts to broadcast: below 100 MB.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class Parts:
    """Into how many parts rows are cut, and how many keys they have.

    A part may end within one key and go on with the next, so there are at
    most ``entries`` pairs of key and part.
    """

    count: int
    keys: int

    @classmethod
    def of(cls, rows: int, keys: int, group_rows: int) -> Parts:
        """Parts of ``group_rows`` rows; of more, up to ``GROUP_ROWS``, if these were very many."""
        wanted, fewest = math.ceil(rows / group_rows) + 1, math.ceil(rows / GROUP_ROWS) + 1
        return cls(min(wanted, max(fewest, MAX_SMALL_PARTS), MAX_PARTS), keys)

    def size(self, rows: int) -> int:
        """How many of the rows a part holds."""
        return math.ceil(rows / self.count)

    @property
    def entries(self) -> int:
        return self.count + self.keys

    def times(self, rows: int, keys: int) -> Parts:
        return Parts(min(self.count * rows, MAX_PARTS), self.keys * keys)


def ordering(names: Sequence[str]) -> list[Column]:
    """Sort columns from names like ``at`` or ``at desc``, NULLs always last."""
    columns = []
    for name in names:
        column = F.col(name.removesuffix(" desc"))
        columns.append(column.desc_nulls_last() if name.endswith(" desc") else column.asc_nulls_last())
    return columns


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, right_rows: int | None = None) -> DataFrame:
    """Equi-join on keys in which NULL equals NULL; keeps the left keys only.

    ``right_rows`` is an upper bound of the right side, if one is known; a
    small right side is broadcast.
    """
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    if right_rows is not None and right_rows <= BROADCAST_ROWS:
        renamed = F.broadcast(renamed)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    joined = left.join(renamed, on, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def large_groups(df: DataFrame, keys: Sequence[str], group_rows: int = GROUP_ROWS) -> DataFrame:
    """Keys of the groups with more than ``group_rows`` rows, and their size.

    The counts are combined on the map side; the result has at most
    ``rows / group_rows`` rows.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") > group_rows)


def parts_needed(df: DataFrame, keys: Sequence[str], group_rows: int = GROUP_ROWS) -> Parts | None:
    """How to cut the rows into parts; None if each group fits a task."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    largest, total, groups = sizes.agg(F.max("_size"), F.sum("_size"), F.count(F.lit(1))).first()
    if largest is None or largest <= group_rows:
        return None
    return Parts.of(total, groups, group_rows)


def cut_into_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: Parts, unique: bool = True) -> DataFrame:
    """Number stretches of consecutive rows in a column ``_part``.

    ``order`` must end in something unique, so that the range boundaries can
    fall anywhere.  The boundaries come from a sample and would differ if the
    plan ran twice, hence the rows are written out together with their number,
    all rows of a part next to each other.

    Without ``unique``, rows of one place may lie in any of the parts that the
    place fills.  Rows then move once, as boundaries drawn ahead tell their part.
    """
    if unique:
        ranged = df.repartitionByRange(parts.count, *ordering([*keys, *order]))
        numbered = ranged.withColumn(PART, F.spark_partition_id())
    else:
        numbered = _numbered_by_place(df, [*keys, *order], parts)
    placed = numbered.repartitionById(parts.count, F.col(PART)).sortWithinPartitions(*keys, PART, *ordering(order))
    return cut_lineage_in_place(placed)


def _numbered_by_place(df: DataFrame, names: Sequence[str], parts: Parts) -> DataFrame:
    """The part of each row by boundaries from a sample of the sorted columns; columns that fall are numbers.

    A place that is a boundary more than once belongs to very many rows.  They
    are dealt to the parts it fills by a hash of the row, and for copies of a
    whole row by the partition each comes from.
    """
    # Structs are compared field by field; NULLs go last.
    columns = [(F.col(name.removesuffix(" desc")), name.endswith(" desc")) for name in names]
    fields = [field for x, falling in columns for field in (x.isNull(), -x if falling else x)]
    placed = df.withColumn("_place", F.struct(*[field.alias(f"f{k}") for k, field in enumerate(fields)]))
    share = min(1.0, min(MAX_SAMPLED_ROWS, SAMPLED_ROWS * parts.count) / max(1, df.count()))
    places = placed.select("_place").sample(share, seed=1).agg(F.sort_array(F.collect_list("_place")).alias("_places"))
    cuts = f"transform(sequence(1, {parts.count - 1}), k -> get(_places, cast(k * size(_places) div {parts.count} as int)))"
    drawn = places.selectExpr(f"{cuts} as _bounds")
    text = drawn.select(F.to_json("_bounds", TIMES)).first()[0]
    bounds = F.sort_array(F.from_json(F.lit(text), drawn.schema["_bounds"].dataType, TIMES))  # a constant

    def below(compared: Callable[[Column, Column], Column]) -> Column:
        """How many boundaries are below a place, by binary search."""

        def further(at: Column, step: Column) -> Column:
            found = (at + step < parts.count) & compared(F.get(bounds, at + step - 1), F.col("_place"))
            return F.when(found, at + step).otherwise(at)

        steps = [F.lit(1 << k) for k in reversed(range((parts.count - 1).bit_length()))]
        return F.aggregate(F.array(*steps), F.lit(0), further)

    # Only rows at a boundary that comes twice look for the parts it fills.
    many = F.get(bounds, F.col("_low") + 1).eqNullSafe(F.col("_place"))
    dealt = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id())
    shift = F.when(many, F.pmod(dealt, below(operator.le) - F.col("_low"))).otherwise(0)
    found = placed.withColumn("_low", below(operator.lt))
    return found.withColumn(PART, (F.col("_low") + shift).cast("int")).drop("_place", "_low")


def arrange(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: Parts | None) -> DataFrame:
    """Cut into parts where needed."""
    return cut_into_parts(df, keys, order, parts) if parts else df


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, tuple[str, str]] | None = None,
    seen: dict[str, str] | None = None,
    parts: Parts | None = None,
    coming: dict[str, str] | None = None,
) -> DataFrame:
    """Add what lies ahead of each row within its key, or behind it.

    ``sums`` maps a new column to (expression, type): the sum over the rows
    ahead, 0 if there is none.  Give decimal types a precision of at most 37,
    as adding two of 38 digits costs scale.

    ``seen`` maps a new column to an expression: its last non-NULL value ahead.
    ``coming`` does the same for the first non-NULL value behind; it costs a
    sort in the other direction, but no shuffle.

    ``order`` must be unique within the keys, for ``seen`` and ``coming`` also
    ascending and without NULLs.  With ``parts``, ``df`` comes from :func:`cut_into_parts` for
    the same keys and order.
    """
    sums, seen, coming = sums or {}, seen or {}, coming or {}
    groups = [*keys, PART] if parts else list(keys)
    ahead = Window.partitionBy(*groups).orderBy(*ordering(order)).rowsBetween(Window.unboundedPreceding, -1)
    # The rows behind are those ahead in the opposite order.  A frame that ends with the group would be run anew for each row.
    backwards = [F.col(name).desc_nulls_last() for name in order]
    behind = Window.partitionBy(*groups).orderBy(*backwards).rowsBetween(Window.unboundedPreceding, -1)

    def total(x: Column, dtype: str) -> Column:
        return F.coalesce(x.cast(dtype), F.lit(0).cast(dtype))

    def last(x: Column, window: Window) -> Column:
        return F.last(x, ignorenulls=True).over(window)

    local = df.withColumns(
        {n: total(F.sum(F.expr(x)).over(ahead), t) for n, (x, t) in sums.items()}
        | {n: last(F.expr(x), ahead) for n, x in seen.items()}
        | {n: last(F.expr(x), behind) for n, x in coming.items()}
    )
    if not parts:
        return local

    def place(x: str) -> Column:
        return F.when(F.expr(x).isNotNull(), F.struct(*order))

    # One row per key and part: what the part adds for the parts behind it, and ahead of it.
    ends = df.groupBy(*groups).agg(
        *[F.sum(F.expr(x)).alias(n) for n, (x, _) in sums.items()],
        *[F.max_by(F.expr(x), place(x)).alias(n) for n, x in seen.items()],
        *[F.min_by(F.expr(x), place(x)).alias(n) for n, x in coming.items()],
    )
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.col(PART).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *groups,
        *[total(F.sum(n).over(earlier), t).alias(f"_carried_{n}") for n, (_, t) in sums.items()],
        *[last(F.col(n), earlier).alias(f"_carried_{n}") for n in seen],
        *[last(F.col(n), later).alias(f"_carried_{n}") for n in coming],
    )
    joined = match(local, carried, groups, "left", parts.entries)
    return joined.withColumns(
        {n: (F.col(n) + F.col(f"_carried_{n}")).cast(t) for n, (_, t) in sums.items()}
        | {n: F.coalesce(n, f"_carried_{n}") for n in [*seen, *coming]}
    ).drop(*[f"_carried_{n}" for n in [*sums, *seen, *coming]])
