"""The daily user-activity summary, step by step and as one job."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType

from daybook.functions import with_defaults
from daybook.operators import (
    attach_rollup,
    enrich_left,
    event_rollup,
    exclude_flagged,
    filter_between,
    keep_latest,
    keep_positive,
    lookup_groups,
    purchase_rollup,
    rank_latest,
    require_not_null,
    usable_lookup,
)
from daybook.schemas import (
    ENRICHED_PURCHASE,
    ENRICHED_USER_EVENT,
    PROFILE_DEFAULTS,
    PURCHASE,
    USER_ACTIVITY_SUMMARY,
    USER_EVENT,
    USER_PROFILE,
)
from daybook.sinks import write_typed
from daybook.sources import scan_typed

# How each source is deduplicated; the tiebreak settles equal timestamps.
EVENT_RECENCY = {
    "keys": ["user_id", "session_id", "event_type"],
    "order": "event_timestamp",
    "tiebreak": ["event_id"],
}
PURCHASE_RECENCY = {
    "keys": ["transaction_id"],
    "order": "purchase_timestamp",
    "tiebreak": ["product_id", "purchase_amount", "payment_method"],
}
ACTIVE = "is_active"


def valid_events(events: DataFrame, start: int, end: int) -> DataFrame:
    """Events in the inclusive date range that name a type and a user."""
    return require_not_null(
        filter_between(events, "partition_date", start, end), "event_type", "user_id"
    )


def valid_purchases(purchases: DataFrame, start: int, end: int) -> DataFrame:
    """Purchases in the inclusive date range, not refunded, of a positive amount."""
    in_range = filter_between(purchases, "partition_date", start, end)
    return keep_positive(exclude_flagged(in_range, "is_refunded"), "purchase_amount")


def ranked_events(events: DataFrame, start: int, end: int) -> DataFrame:
    """Valid events with their recency rank per user, session and type."""
    return rank_latest(valid_events(events, start, end), **EVENT_RECENCY)


def ranked_purchases(purchases: DataFrame, start: int, end: int) -> DataFrame:
    """Valid purchases with their recency rank per transaction."""
    return rank_latest(valid_purchases(purchases, start, end), **PURCHASE_RECENCY)


def latest_events(events: DataFrame, start: int, end: int) -> DataFrame:
    """The rank-1 rows of ranked_events, without ranking the others."""
    return keep_latest(valid_events(events, start, end), **EVENT_RECENCY)


def latest_purchases(purchases: DataFrame, start: int, end: int) -> DataFrame:
    """The rank-1 rows of ranked_purchases, without ranking the others."""
    return keep_latest(valid_purchases(purchases, start, end), **PURCHASE_RECENCY)


def enrich_events(latest: DataFrame, profiles: DataFrame) -> DataFrame:
    """Latest events with their user's active profile or its defaults."""
    enriched = enrich_left(latest, profiles, "user_id", PROFILE_DEFAULTS, ACTIVE)
    return enriched.select(*ENRICHED_USER_EVENT.names)


def enrich_purchases(latest: DataFrame, profiles: DataFrame) -> DataFrame:
    """Latest purchases with their user's active profile or its defaults."""
    enriched = enrich_left(latest, profiles, "user_id", PROFILE_DEFAULTS, ACTIVE)
    return enriched.select(*ENRICHED_PURCHASE.names)


def aggregate_user_activity(
    enriched_events: DataFrame,
    enriched_purchases: DataFrame,
    amount_type: DataType | None = None,
) -> DataFrame:
    """Summary of frames that were enriched row by row.

    A user's purchase totals cover the whole range and repeat on each of the
    user's dates; users with purchases but no events do not appear.
    """
    keys = ["user_id", *PROFILE_DEFAULTS, "partition_date"]
    summary = attach_rollup(
        event_rollup(enriched_events, keys),
        purchase_rollup(enriched_purchases, amount_type, after_join=True),
        "user_id",
    )
    return summary.select(*USER_ACTIVITY_SUMMARY.names)


def active_by_user(profiles: DataFrame) -> DataFrame:
    """Active profiles, those of a user together in one partition.

    Grouping and joining by user then need no further shuffle, and Spark runs this one
    once for all steps that start from it.
    """
    active = usable_lookup(profiles, ACTIVE).select("user_id", *PROFILE_DEFAULTS)
    return active.repartition("user_id")


def enriched_event_rollup(latest: DataFrame, profiles: DataFrame) -> DataFrame:
    """event_rollup of enrich_events, with the profiles joined after the rollup.

    The join then moves one row per user and date instead of one per event, and
    no user is too large for it.
    """
    return _with_profiles(event_rollup(latest), active_by_user(profiles))


def _with_profiles(rollup: DataFrame, active: DataFrame) -> DataFrame:
    groups = lookup_groups(active, "user_id", PROFILE_DEFAULTS)
    joined = rollup.join(groups, "user_id", "left")
    repeated = with_defaults(joined, {**PROFILE_DEFAULTS, "copies": 1})
    return repeated.withColumn(
        "total_events", F.col("total_events") * F.col("copies")
    ).drop("copies")


def enriched_purchase_rollup(
    latest: DataFrame, profiles: DataFrame, amount_type: DataType | None = None
) -> DataFrame:
    """purchase_rollup of enrich_purchases, with the profiles joined afterwards.

    A rollup per user uses no profile column; only how often a user's purchases
    would repeat for want of a unique profile.
    """
    # Counted before the shuffle, and without the profiles' columns.
    active = usable_lookup(profiles, ACTIVE)
    copies = active.groupBy("user_id").agg(F.count("*").alias("copies"))
    return _repeated(purchase_rollup(latest, amount_type), copies)


def _repeated(rollup: DataFrame, copies: DataFrame) -> DataFrame:
    joined = rollup.join(copies, "user_id", "left")
    repeat = F.coalesce("copies", F.lit(1))
    return joined.withColumns(
        {
            "total_purchases": F.col("total_purchases") * repeat,
            "total_purchase_amount": F.col("total_purchase_amount") * repeat,
        }
    ).drop("copies")


def user_activity_summary(
    events: DataFrame,
    purchases: DataFrame,
    profiles: DataFrame,
    start: int,
    end: int,
    amount_type: DataType | None = None,
) -> DataFrame:
    """Activity per user and date, with profile and purchase totals.

    Equal to aggregate_user_activity over the enriched frames, but every input
    is rolled up before it is joined.
    """
    active = active_by_user(profiles)
    # Copies from the same groups as the events' profiles, so that Spark shuffles them once.
    groups = lookup_groups(active, "user_id", PROFILE_DEFAULTS)
    copies = groups.groupBy("user_id").agg(F.sum("copies").alias("copies"))
    summary = attach_rollup(
        _with_profiles(event_rollup(latest_events(events, start, end)), active),
        _repeated(purchase_rollup(latest_purchases(purchases, start, end), amount_type), copies),
        "user_id",
    )
    return summary.select(*USER_ACTIVITY_SUMMARY.names)


def run_user_activity(
    spark: SparkSession,
    start: int,
    end: int,
    events_table: str,
    purchases_table: str,
    output_table: str,
    profiles_table: str = "lookup_user",
    amount_type: DataType | None = None,
    output_path: str | None = None,
) -> None:
    """Read the three tables, summarise, and overwrite the output table."""
    summary = user_activity_summary(
        scan_typed(spark, events_table, USER_EVENT),
        scan_typed(spark, purchases_table, PURCHASE),
        scan_typed(spark, profiles_table, USER_PROFILE),
        start,
        end,
        amount_type,
    )
    write_typed(summary, output_table, USER_ACTIVITY_SUMMARY, path=output_path)
