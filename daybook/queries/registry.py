"""One query per operator, over whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from daybook.functions import earliest, fill_zero, with_defaults
from daybook.operators import (
    attach_rollup,
    conform,
    daily_activity,
    enrich_left_spread,
    exclude_flagged,
    filter_between,
    keep_positive,
    most_common_values,
    purchase_rollup,
    require_not_null,
)
from daybook.plans.user_activity import (
    enrich_events,
    enrich_purchases,
    enriched_event_rollup,
    enriched_purchase_rollup,
    latest_events,
    latest_purchases,
    ranked_events,
    ranked_purchases,
    run_user_activity,
    user_activity_summary,
)
from daybook.queries.inputs import lookup_user, purchases, table, table_name, user_events
from daybook.schemas import PROFILE_DEFAULTS, PURCHASE, USER_ACTIVITY_SUMMARY, USER_EVENT
from daybook.scratch import new_table
from daybook.sinks import (
    write_compact,
    write_partitioned,
    write_table,
    write_typed,
    write_typed_partitioned,
)
from daybook.sources import scan_columns, scan_table, scan_typed

Query = Callable[[SparkSession, str], DataFrame]

START, END = 20240105, 20240120
# Test amounts have two decimals. Summing them exactly gives the same totals in
# every engine, whatever the order of addition.
CENTS = T.DecimalType(18, 2)

# lineitem with l_linenumber declared wider than it is stored.
LINE = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_linenumber", T.LongType()),
        T.StructField("l_partkey", T.StringType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_shipdate", T.TimestampType()),
    ]
)

QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Sources


@_query
def src_scan_table(spark, sf_dir):
    return scan_table(spark, table_name(sf_dir, "orders"))


@_query
def src_typed_conform(spark, sf_dir):
    return scan_typed(spark, table_name(sf_dir, "lineitem"), LINE)


@_query
def src_project_columns(spark, sf_dir):
    name = table_name(sf_dir, "lineitem")
    return scan_columns(spark, name, ["l_orderkey", "l_linenumber", "l_extendedprice"])


# Sinks: write a new table in the shared scratch folder, then scan it by name.


@_query
def snk_overwrite_roundtrip(spark, sf_dir):
    target = new_table(spark)
    write_table(table(spark, sf_dir, "customer"), **target)
    write_table(table(spark, sf_dir, "orders"), **target)
    return scan_table(spark, target["name"])


@_query
def snk_typed_roundtrip(spark, sf_dir):
    target = new_table(spark)
    write_typed(table(spark, sf_dir, "lineitem"), schema=LINE, **target)
    return scan_typed(spark, target["name"], LINE)


@_query
def snk_append(spark, sf_dir):
    """Two customer extracts in one table; the second has its columns reversed."""
    target = new_table(spark)
    customers = table(spark, sf_dir, "customer")
    in_debt = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    write_table(customers.where(~in_debt), **target)
    write_table(
        customers.where(in_debt).select(*reversed(customers.columns)), mode="append", **target
    )
    return scan_table(spark, target["name"])


@_query
def snk_ignore(spark, sf_dir):
    """The second write finds the table present and changes nothing."""
    target = new_table(spark)
    orders = table(spark, sf_dir, "orders")
    write_table(orders, mode="ignore", **target)
    write_table(orders.where("o_totalprice > 1000"), mode="ignore", **target)
    return scan_table(spark, target["name"])


@_query
def snk_partitioned_pruned_read(spark, sf_dir):
    target = new_table(spark)
    bought = purchases(spark, sf_dir)
    write_partitioned(bought, partition_columns=["partition_date"], **target)
    stored = filter_between(scan_table(spark, target["name"]), "partition_date", START, END)
    return stored.select(*bought.columns)


@_query
def snk_typed_partitioned(spark, sf_dir):
    target = new_table(spark)
    write_typed_partitioned(
        user_events(spark, sf_dir),
        schema=USER_EVENT,
        partition_columns=["partition_date"],
        **target,
    )
    return scan_typed(spark, target["name"], USER_EVENT)


@_query
def snk_compact_roundtrip(spark, sf_dir):
    target = new_table(spark)
    write_compact(table(spark, sf_dir, "lineitem"), target_file_mb=128, **target)
    return scan_table(spark, target["name"])


# Filters


@_query
def flt_date_range(spark, sf_dir):
    return filter_between(user_events(spark, sf_dir), "partition_date", START, END)


@_query
def flt_required_not_null(spark, sf_dir):
    return require_not_null(user_events(spark, sf_dir), "event_type", "user_id")


@_query
def flt_not_refunded(spark, sf_dir):
    return exclude_flagged(purchases(spark, sf_dir), "is_refunded")


@_query
def flt_positive_amount(spark, sf_dir):
    return keep_positive(purchases(spark, sf_dir), "purchase_amount")


@_query
def flt_active_profiles(spark, sf_dir):
    return lookup_user(spark, sf_dir).where("is_active")


# Ranking and deduplication


@_query
def win_event_recency_rank(spark, sf_dir):
    return ranked_events(user_events(spark, sf_dir), START, END)


@_query
def win_purchase_recency_rank(spark, sf_dir):
    return ranked_purchases(purchases(spark, sf_dir), START, END)


@_query
def dedup_latest_event(spark, sf_dir):
    return latest_events(user_events(spark, sf_dir), START, END)


@_query
def dedup_latest_purchase(spark, sf_dir):
    return latest_purchases(purchases(spark, sf_dir), START, END)


# Missing values


@_query
def fn_coalesce_defaults(spark, sf_dir):
    profiles = with_defaults(lookup_user(spark, sf_dir), PROFILE_DEFAULTS)
    return profiles.select("user_id", *PROFILE_DEFAULTS)


@_query
def fn_fill_zero(spark, sf_dir):
    """Totals per profile; profiles without purchases show 0, not null."""
    totals = purchase_rollup(purchases(spark, sf_dir), CENTS)
    joined = lookup_user(spark, sf_dir).select("user_id", "username").join(totals, "user_id", "left")
    return fill_zero(joined, "total_purchases", "total_purchase_amount", "avg_purchase_amount")


# Joins


@_query
def join_enrich_events(spark, sf_dir):
    return enrich_events(
        latest_events(user_events(spark, sf_dir), START, END), lookup_user(spark, sf_dir)
    )


@_query
def join_enrich_purchases(spark, sf_dir):
    return enrich_purchases(
        latest_purchases(purchases(spark, sf_dir), START, END), lookup_user(spark, sf_dir)
    )


@_query
def join_enrich_hot_key(spark, sf_dir):
    """A third of the purchases share a user, who has two profiles."""
    hot = F.expr("if(payment_method = 'credit', '22', user_id)")
    bought = purchases(spark, sf_dir).withColumn("user_id", hot)
    return enrich_left_spread(
        bought, lookup_user(spark, sf_dir), "user_id", PROFILE_DEFAULTS, "is_active"
    )


@_query
def join_event_purchase_rollups(spark, sf_dir):
    profiles = lookup_user(spark, sf_dir)
    events = latest_events(user_events(spark, sf_dir), START, END)
    bought = latest_purchases(purchases(spark, sf_dir), START, END)
    return attach_rollup(
        enriched_event_rollup(events, profiles),
        enriched_purchase_rollup(bought, profiles, CENTS),
        "user_id",
    )


@_query
def join_inner_daily_activity(spark, sf_dir):
    return daily_activity(user_events(spark, sf_dir), lookup_user(spark, sf_dir), START)


# Aggregates


@_query
def agg_event_rollup(spark, sf_dir):
    return enriched_event_rollup(
        latest_events(user_events(spark, sf_dir), START, END), lookup_user(spark, sf_dir)
    )


@_query
def agg_purchase_rollup(spark, sf_dir):
    return enriched_purchase_rollup(
        latest_purchases(purchases(spark, sf_dir), START, END), lookup_user(spark, sf_dir), CENTS
    )


def _events_by_day(spark: SparkSession, sf_dir: str):
    return user_events(spark, sf_dir).groupBy("user_id", "partition_date")


@_query
def agg_count_star(spark, sf_dir):
    return _events_by_day(spark, sf_dir).agg(F.count("*").alias("total_events"))


@_query
def agg_count_distinct(spark, sf_dir):
    return _events_by_day(spark, sf_dir).agg(
        F.countDistinct("session_id").alias("unique_sessions")
    )


@_query
def agg_mode(spark, sf_dir):
    return most_common_values(
        user_events(spark, sf_dir), ["user_id", "partition_date"], ["device_type", "event_type"]
    )


@_query
def agg_first(spark, sf_dir):
    return _events_by_day(spark, sf_dir).agg(
        earliest("device_type", "event_timestamp", ["event_id"]).alias("first_device"),
        earliest("event_type", "event_timestamp", ["event_id"]).alias("first_event_type"),
    )


@_query
def agg_min_max(spark, sf_dir):
    return _events_by_day(spark, sf_dir).agg(
        F.min("event_timestamp").alias("first_event_timestamp"),
        F.max("event_timestamp").alias("last_event_timestamp"),
    )


@_query
def agg_sum_avg(spark, sf_dir):
    return purchase_rollup(conform(purchases(spark, sf_dir), PURCHASE), CENTS)


# The whole job


def _summary(spark, sf_dir):
    return user_activity_summary(
        user_events(spark, sf_dir),
        purchases(spark, sf_dir),
        lookup_user(spark, sf_dir),
        START,
        END,
        CENTS,
    )


QUERIES["user_activity_summary"] = _summary


@_query
def job_tables_roundtrip(spark, sf_dir):
    """The job from tables to table, then a scan of what it wrote."""
    events, bought, users, output = (new_table(spark) for _ in range(4))
    write_partitioned(user_events(spark, sf_dir), partition_columns=["partition_date"], **events)
    write_partitioned(purchases(spark, sf_dir), partition_columns=["partition_date"], **bought)
    write_table(lookup_user(spark, sf_dir), **users)
    run_user_activity(
        spark,
        START,
        END,
        events["name"],
        bought["name"],
        output["name"],
        users["name"],
        CENTS,
        output["path"],
    )
    return scan_typed(spark, output["name"], USER_ACTIVITY_SUMMARY)
