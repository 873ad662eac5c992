"""Full-refresh tables, kept in sort order, one namespace per layer.

A table is rebuilt aside and then put in the place of the old one by a change of
the catalog alone, so a rebuild that fails leaves the old table as it was.

The rows of a model are computed once and staged.  How many files they need
follows from the bytes staged, and which file a row belongs to from a sketch of
the sort column, which is all that is read a second time to draw the boundaries.
"""

from __future__ import annotations

import math
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from tallybook.session import remove_folder

# The namespaces of the layers.
LAYERS = {"raw": "vault_raw", "business": "vault_business", "mart": "mart_core"}

TARGET_BYTES = 256 << 20  # of a file
BUCKET_ROWS = 4_000_000  # of a bucket, at most
MAX_SMALL_BUCKETS = 256  # buckets of fewer rows grow rather than become more than this

# A sketch gives at most so many boundaries, a file spans several ranges between them.
MAX_POINTS, POINTS_PER_FILE = 8_192, 8
SKETCH_ACCURACY = 100_000
PREFIX_BYTES = 6  # of a text that count, behind what all texts have in common; a double holds them exactly


def namespace(layer: str, env: str = "prod", default: str = "dev") -> str:
    """Layer namespace in production, one common namespace elsewhere."""
    return LAYERS[layer] if env == "prod" else default


def table_name(layer: str, name: str, env: str = "prod", default: str = "dev") -> str:
    return f"{namespace(layer, env, default)}.{name}"


# -- which file a row belongs to -------------------------------------------------


def _rank(df: DataFrame, column: str) -> Column | None:
    """A number in the order of the column's values, NULL first; None for types without one.

    Values that get the same number count as one value to the sketch.
    """
    kind, x = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        number = F.unix_micros(x.cast("timestamp")).cast("double")
    elif isinstance(kind, DateType):
        number = F.unix_date(x).cast("double")
    elif isinstance(kind, NumericType):
        number = x.cast("double")
    elif isinstance(kind, StringType):
        least, most = df.agg(F.min(x), F.max(x)).first()
        least, most = (least or "").encode(), (most or "").encode()
        common = next((k for k, (a, b) in enumerate(zip(least, most)) if a != b), min(len(least), len(most)))
        digits = F.hex(F.substring(F.encode(x, "UTF-8"), common + 1, PREFIX_BYTES))
        number = F.conv(F.rpad(digits, 2 * PREFIX_BYTES, "0"), 16, 10).cast("double")
    else:
        return None
    return F.coalesce(F.nanvl(number, F.lit(float("inf"))), F.lit(float("-inf")))


def boundaries(df: DataFrame, rank: Column, points: int) -> list[float]:
    """Quantiles of a column from a mergeable sketch: one pass, and one small state a task."""
    shares = [k / (points + 1) for k in range(1, points + 1)]
    return df.agg(F.percentile_approx(rank, shares, SKETCH_ACCURACY)).first()[0] or []


def _count_below(bounds: list[float], x: str, equal_too: bool) -> Column:
    """How many boundaries are below a value, by binary search."""
    known = ",".join("Infinity" if b == math.inf else "-Infinity" if b == -math.inf else repr(float(b)) for b in bounds)
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
    found = f"get(cast(split('{known}', ',') as array<double>), at + step - 1) {'<=' if equal_too else '<'} {x}"
    further = f"if(at + step <= {len(bounds)} and {found}, at + step, at)"
    return F.expr(f"aggregate(array({', '.join(map(str, steps))}), 0, (at, step) -> {further})")


def in_sort_order(df: DataFrame, sort_by: str, files: int = 1) -> DataFrame:
    """Cut into ``files`` files of about equal size by ranges of a column, sorted within.

    Boundaries come from a sketch of the column.  A value that is a boundary
    more than once belongs to very many rows; they are dealt by a hash of the
    row, and for copies of a whole row by the partition each comes from, to
    the ranges that the value fills.  Beyond one file a range, a range's rows are dealt to several.
    """
    rank = _rank(df, sort_by) if files > 1 else None
    if rank is None:
        placed = df.coalesce(1) if files == 1 else df.repartitionByRange(files, F.col(f"`{sort_by}`"))
        return placed.sortWithinPartitions(F.col(f"`{sort_by}`"))
    bounds = boundaries(df, rank, min(MAX_POINTS, POINTS_PER_FILE * files) - 1)
    ranges = len(bounds) + 1
    origin = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id())
    placed = df.withColumn("_rank", rank).withColumn("_dealt", origin)
    placed = placed.withColumn("_low", _count_below(bounds, "_rank", False)).withColumn("_high", _count_below(bounds, "_rank", True))
    spread = "_low + if(_high > _low + 1, pmod(_dealt, _high - _low), 0)"
    within = f"pmod(shiftright(_dealt, 20), {1 << 20}) / {float(1 << 20)}" if files > ranges else "0"
    file = F.expr(f"least({files - 1}, cast(floor(({spread} + {within}) * {files} / {ranges}) as int))")
    return placed.repartitionById(files, file).drop("_rank", "_dealt", "_low", "_high").sortWithinPartitions(F.col(f"`{sort_by}`"))


def in_key_order(df: DataFrame, key: str, files: int = 1) -> DataFrame:
    """The same for a unique MD5 key in hexadecimal.

    Such keys are spread evenly, so the file of a row follows from the first
    digits of its key, and no sketch is needed.
    """
    start = f"coalesce(cast(conv(substring(`{key}`, 1, 8), 16, 10) as bigint), 0)"
    placed = df.repartitionById(files, F.expr(f"cast({start} * {files} div {16**8} as int)"))
    return placed.sortWithinPartitions(F.col(f"`{key}`"))


def files_for(size: int, target_bytes: int = TARGET_BYTES) -> int:
    return max(1, round(size / target_bytes))


def buckets_for(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """A power of two that follows from the rows alone: tables with one row a key get the same number.

    A bucket is a file and a task, whose commit goes to the driver, and Spark allows 100,000.
    """

    def needed(size: int) -> int:
        return 1 << max(0, math.ceil(math.log2(max(1, rows) / size)))

    return min(needed(bucket_rows), max(needed(BUCKET_ROWS), MAX_SMALL_BUCKETS))


# -- writing ---------------------------------------------------------------------


def _bytes_of(spark: SparkSession, path: str) -> int:
    """Size of the files of a folder; their contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _shape(spark: SparkSession, table: str) -> tuple:
    """Columns, provider and buckets: what has to be equal for one table's files to serve as another's."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    wanted = ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns")
    return spark.table(table).dtypes, sorted((r["col_name"], r["data_type"]) for r in rows if r["col_name"] in wanted)


def _swap(spark: SparkSession, target: str, built: str) -> None:
    """Let ``target`` have the files of ``built``, which is no table of its own afterwards.

    With columns and buckets as before this is one change of the catalog; else
    the old entry goes and the new one takes its name.  No file is moved.
    """
    if not spark.catalog.tableExists(target):
        spark.sql(f"ALTER TABLE {built} RENAME TO {target}")
        return
    old, new = _location(spark, target), _location(spark, built)
    if _shape(spark, target) == _shape(spark, built):
        spark.sql(f"ALTER TABLE {target} SET LOCATION '{new}'")
        spark.sql(f"DROP TABLE {built}")
    else:
        spark.sql(f"DROP TABLE {target}")
        spark.sql(f"ALTER TABLE {built} RENAME TO {target}")
    spark.sql(f"REFRESH TABLE {target}")
    remove_folder(spark, old)


def replace_table(df: DataFrame, target: str, bucket_by: str | None = None, buckets: int = 0) -> None:
    """Write rows as a new version of a table, then swap it in.

    A failing write leaves the old table, and nothing of the new one.  Readers
    that still hold the old files when they go have to read again.
    """
    spark = df.sparkSession
    folder, name = target.split(".")
    version = f"{name}__{uuid4().hex}"
    path = f"{spark.catalog.getDatabase(folder).locationUri.rstrip('/')}/{version}"
    writer = df.write.format("parquet").option("path", path)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    try:
        writer.saveAsTable(f"{folder}.{version}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {folder}.{version}")
        remove_folder(spark, path)
        raise
    _swap(spark, target, f"{folder}.{version}")


def write_layer(
    df: DataFrame,
    layer: str,
    name: str,
    sort_by: str | None = None,
    env: str = "prod",
    default: str = "dev",
    unique_key: bool = False,
    bucket_by: str | None = None,
    target_bytes: int = TARGET_BYTES,
    bucket_rows: int = BUCKET_ROWS,
) -> str:
    """Replace the table of a model and return its name.

    ``unique_key`` says that ``sort_by`` is an MD5 key that hardly repeats.
    ``bucket_by`` keeps the rows by a hash of a key instead, sorted within:
    tables of as many rows with the same key are then joined without a shuffle.
    """
    spark = df.sparkSession
    home = namespace(layer, env, default)
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {home}")
    target = table_name(layer, name, env, default)
    if not (sort_by or bucket_by):
        replace_table(df, target)
        return target
    staged = f"{spark.catalog.getDatabase(home).locationUri.rstrip('/')}/{name}__staged_{uuid4().hex}"
    try:
        df.write.parquet(staged)
        rows = spark.read.schema(df.schema).parquet(staged)
        if bucket_by:
            buckets = buckets_for(rows.count(), bucket_rows)
            replace_table(rows.repartition(buckets, F.col(bucket_by)), target, bucket_by, buckets)
        else:
            files = files_for(_bytes_of(spark, staged), target_bytes)
            arrange = in_key_order if unique_key else in_sort_order
            replace_table(arrange(rows, sort_by, files), target)
    finally:
        remove_folder(spark, staged)
    return target
