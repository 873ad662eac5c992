"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores of the local session (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from parity.catalog import QUERIES
from tallybook.plans.models import MODELS

OPERATORS = ["natural_key", "keep_one", "split_amount", "fx_at_minute", "signed_position", "split_legs", "fifo_match"]
OPERATORS += ["fifo_lots", "running_balance", "hub_key_report"]
# What is meant for large groups, with groups cut into parts, and a table written and read back.
OPERATORS += [name for name in QUERIES if name.endswith("_in_parts")] + ["written_table"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallybook-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or [*MODELS, *OPERATORS]
    # Start the JVM's readers, shuffles and code generation off the clock.
    QUERIES["keep_one"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "seconds for all queries, source tables to last row",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
