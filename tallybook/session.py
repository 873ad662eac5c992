"""Session settings the models rely on."""

from __future__ import annotations

import tempfile
from threading import Lock

from pyspark.sql import DataFrame, SparkSession


# The JVM interprets a method above this size, however often it runs.
JIT_LIMIT_BYTES = 8000

PLANNING = Lock()


def prepare(spark: SparkSession) -> SparkSession:
    """Make the settings the models rely on.

    The session zone is UTC: so are minute buckets and exports without zone.
    Berlin wall time is a matter of display (``functions.times.berlin``).

    Satellites with very many measures generate methods the JVM would not
    compile; with the limit lowered, Spark splits them.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > JIT_LIMIT_BYTES:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_LIMIT_BYTES)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; on a
    cluster a missing shared folder is an error, as an executor's local disk
    does not outlive the executor.
    """
    context = spark.sparkContext
    if current := context.getCheckpointDir():
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="tallybook-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def cut_lineage_in_place(df: DataFrame) -> DataFrame:
    """The same, but Spark remembers how the rows are partitioned and sorted.

    An adaptive plan does not tell, so this one is fixed in advance.  Later
    windows and aggregations over the same columns then need no shuffle.  The
    session's setting is changed while the plan is made, by one thread at a
    time, and is back before the job starts.
    """
    ensure_checkpoint_dir(df.sparkSession)
    conf = df.sparkSession.conf
    with PLANNING:
        adaptive = conf.get("spark.sql.adaptive.enabled")
        conf.set("spark.sql.adaptive.enabled", "false")
        try:
            df._jdf.queryExecution().executedPlan()  # made once, then kept
        finally:
            conf.set("spark.sql.adaptive.enabled", adaptive)
    return df.checkpoint()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of files that nothing refers to any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
