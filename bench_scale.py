"""Times the summary and the ranking on larger, skewed copies of the test tables.

SCALE_TIMES copies of the events (a tenth as many of the purchases) are made under new users,
a copy of the profiles for each. In the skewed form one user holds a third of all events, on
one date, and 30 % of the purchases; another 10 % of the purchases name no user. Prints one
JSON line. Tables and checkpoints go to a new folder below SCALE_DIR (default: temporary).
"""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from daybook.operators import rank_latest  # noqa: E402
from daybook.plans.user_activity import (  # noqa: E402
    aggregate_user_activity,
    enrich_events,
    enrich_purchases,
    latest_events,
    latest_purchases,
    user_activity_summary,
)
from daybook.queries import inputs  # noqa: E402

START, END = 20240101, 20991231


def copies(df: DataFrame, times: int) -> DataFrame:
    number = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
    return df.withColumn("copy", number).withColumn(
        "user_id", F.concat("user_id", F.lit("-"), "copy")
    )


def skewed(df: DataFrame, hot: float, nobody: float = 0.0) -> DataFrame:
    draw = F.pmod(F.xxhash64(*df.columns), F.lit(1000)) / 1000
    user = F.when(draw < hot, "hot").when(draw >= hot + nobody, F.col("user_id"))
    day = F.when(draw < hot, 20240110).otherwise(F.col("partition_date"))
    return df.withColumns({"user_id": user, "partition_date": day.cast("int")})


def seconds(build) -> float:
    """The second of two runs."""
    for _ in range(2):
        begin = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - begin, 1)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    times = int(os.environ.get("SCALE_TIMES", "100"))
    folder = tempfile.mkdtemp(prefix="daybook-scale-", dir=os.environ.get("SCALE_DIR"))
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", f"{folder}/checkpoints")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    users = kept(copies(inputs.lookup_user(spark, sf_dir), times), "users")
    events = kept(copies(inputs.user_events(spark, sf_dir), times), "events")
    bought = kept(copies(inputs.purchases(spark, sf_dir), max(1, times // 10)), "purchases")
    forms = {
        "uniform": (events, bought),
        "skewed": (
            kept(skewed(events, 1 / 3), "skewed_events"),
            kept(skewed(bought, 0.3, 0.1), "skewed_purchases"),
        ),
    }
    found = {"events": events.count(), "purchases": bought.count(), "users": users.count()}
    for form, (e, p) in forms.items():
        found[f"summary, roll up first, {form}"] = seconds(
            lambda: user_activity_summary(e, p, users, START, END)
        )
        found[f"summary, join first, {form}"] = seconds(
            lambda: aggregate_user_activity(
                enrich_events(latest_events(e, START, END), users),
                enrich_purchases(latest_purchases(p, START, END), users),
            )
        )
        found[f"rank_latest by user, {form}"] = seconds(
            lambda: rank_latest(e, ["user_id"], "event_timestamp", ["event_id"])
        )
        plain = (
            "row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, event_id) AS n"
        )
        found[f"one window by user, {form}"] = seconds(lambda: e.selectExpr("*", plain))
    spark.stop()
    print(json.dumps(found))


if __name__ == "__main__":
    main()
