"""Time every registered query; prints one JSON line.

Each query runs once to warm up, then BENCH_RUNS times; its figure is the
median. Results are computed in full and discarded (Spark's noop sink); the
sink queries include their writes.
"""

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path
from statistics import median

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from daybook.queries import QUERIES  # noqa: E402


def seconds(spark, query, sf_dir):
    begin = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="daybook-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("daybook-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name, query in QUERIES.items():
        seconds(spark, query, sf_dir)
        timings[name] = round(median(seconds(spark, query, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total time of all queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
