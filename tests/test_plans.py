"""What the physical plans must look like to hold at scale."""

import re
from contextlib import ExitStack, contextmanager
from functools import partial

import pytest
from pyspark.sql import functions as F

from daybook.operators import enrich_left, enrich_left_spread, event_rollup, purchase_rollup
from daybook.plans.user_activity import (
    enrich_events,
    enrich_purchases,
    latest_events,
    latest_purchases,
    user_activity_summary,
    valid_events,
    valid_purchases,
)
from daybook.queries import QUERIES, inputs
from daybook.sinks import write_partitioned, write_table
from daybook.sources import scan_columns, scan_table

SF_DIR = "/root/testdata/sf0.01"
START, END = 20240105, 20240120


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def setting(spark, key, value):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@pytest.fixture(scope="module")
def stored(spark):
    """The three inputs as tables, events and purchases partitioned by date."""
    write_partitioned(inputs.user_events(spark, SF_DIR), "plan_events", ["partition_date"])
    write_partitioned(inputs.purchases(spark, SF_DIR), "plan_purchases", ["partition_date"])
    write_table(inputs.lookup_user(spark, SF_DIR), "plan_users")
    return [scan_table(spark, f"plan_{name}") for name in ("events", "purchases", "users")]


def read_schemas(text):
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_uses_a_cross_join_or_python(spark, name):
    text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoop", "Python", "Pandas", "Arrow"):
        assert unwanted not in text


def test_filters_reach_the_scan(spark, stored):
    events, purchases, _ = stored
    text = plan(valid_events(events, START, END))
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(user_id)]" in text
    assert re.search(r"PartitionFilters: \[isnotnull\(partition_date", text)
    assert "InMemoryFileIndex(16 paths)" in text
    with setting(spark, "spark.sql.maxMetadataStringLength", "1000"):
        text = plan(valid_purchases(purchases, START, END))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text)[1]
    assert "Not(EqualTo(is_refunded,true))" in pushed
    assert "GreaterThan(purchase_amount,0.0)" in pushed


def test_only_needed_columns_are_read(spark, stored):
    assert read_schemas(plan(scan_columns(spark, "plan_events", ["event_id"]))) == [
        "event_id:string"
    ]
    summary = plan(user_activity_summary(*stored, START, END))
    events, *others = sorted(read_schemas(summary), key=lambda s: "session_id" not in s)
    assert "page_url" not in events
    for schema in others:
        assert not re.search("currency|email|registration_date", schema)


def test_deduplication_keeps_one_row_per_key_before_its_shuffle(stored):
    lines = plan(latest_events(stored[0], START, END)).splitlines()
    steps = [
        next(i for i, line in enumerate(lines) if re.search(step, line))
        for step in (
            r"WindowGroupLimit .* Final",
            "Exchange hashpartitioning",
            r"WindowGroupLimit .* Partial",
        )
    ]
    assert steps == sorted(steps)
    assert "\n".join(lines).count("Exchange") == 1


def test_the_summary_joins_rollups_only(spark, stored):
    """Rows are shuffled to be deduplicated and counted, never to be joined."""
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        text = plan(user_activity_summary(*stored, START, END))
    depth = {}
    for line in text.splitlines():
        step = re.search(r"[A-Z]\w+", line)
        if step:
            depth.setdefault(step[0], []).append(step.start())
    assert len(depth["SortMergeJoin"]) == 3
    assert max(depth["SortMergeJoin"]) < min(depth["Window"])
    for shuffle in re.findall(r"Exchange (\w+)", text):
        assert shuffle == "hashpartitioning"
    # Two deduplications, two steps of the event rollup, the purchase rollup, the event
    # rollup by user, and the lookup: planned twice, the second time reused.
    assert text.count("Exchange hashpartitioning") == 8
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        summary = user_activity_summary(*stored, START, END)
        summary.collect()
        ran = plan(summary).partition("Initial Plan")[0]
    # A reused shuffle is printed with the one that it stands for.
    assert ran.count("ReusedExchange") == 1
    assert ran.count("Exchange hashpartitioning") - 1 == 7


SPLIT_EARLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    # Test partitions are so small that all would merge before they could be split.
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.mark.parametrize("roll_up", [False, True])
@pytest.mark.parametrize("source", ["events", "purchases"])
def test_a_hot_user_is_split_when_joined(spark, stored, source, roll_up):
    """A third of the rows share one user, or none; a rollup on top must not undo it."""
    events, purchases, users = stored
    if source == "events":
        hot = F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("user_id"))
        rows = latest_events(events.withColumn("user_id", hot).repartition(8), START, END)
        enriched, rollup = enrich_events(rows, users), event_rollup
    else:
        hot = F.when(F.col("transaction_id") % 3 != 0, F.col("user_id"))
        rows = latest_purchases(purchases.withColumn("user_id", hot).repartition(8), START, END)
        enriched = enrich_purchases(rows, users)
        rollup = partial(purchase_rollup, after_join=True)
    with ExitStack() as stack:
        for key, value in SPLIT_EARLY.items():
            stack.enter_context(setting(spark, key, value))
        result = rollup(enriched) if roll_up else enriched
        result.collect()
        assert "SortMergeJoin(skew=true)" in plan(result)


def test_a_hot_key_is_spread_without_adaptive_execution(spark, tmp_path):
    """Two thirds of the rows, copies too, share a key with several lookup rows."""
    facts = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(1).alias("k"), F.lit(5).alias("same")
    )
    lookup = spark.range(0, 2_000).select((F.col("id") % 1000).alias("k"), F.lit("x").alias("v"))
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    with ExitStack() as stack:
        for key, value in settings.items():
            stack.enter_context(setting(spark, key, value))

        def result(enrich):
            joined = enrich(facts, lookup, "k", {"v": "?"})
            text = plan(joined)
            sizes = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
            return text, sorted(row["count"] for row in sizes), joined.groupBy("k", "v").count()

        _, plain, expected = result(enrich_left)
        text, spread, actual = result(enrich_left_spread)
        assert sorted(actual.collect()) == sorted(expected.collect())
    assert "SortMergeJoin" in text and "BroadcastNestedLoop" not in text
    assert sum(spread) == sum(plain)
    assert max(plain) > sum(plain) / 2
    assert max(spread) < sum(spread) / 4
