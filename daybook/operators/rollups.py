"""Grouped aggregates built to combine before each shuffle.

Every buffer has a fixed size, so a group holding much of the input costs each
task one row rather than a growing set or map.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

from daybook.functions import most_frequent
from daybook.operators.naming import column

# Inside this module keys are k0, k1, ... and attributes v0, v1, ...: the caller's names
# come back at the end, so they can't clash with those of the columns in between.


def _count_values(
    df: DataFrame, keys: Sequence[str], attributes: Sequence[str], time: str | None = None
) -> DataFrame:
    """Rows per (keys, attribute, value), in one pass for all attributes.

    Null is counted as a value of its own. Each attribute has a column of its own type,
    null in the rows of the others. With time, also the first and last of each group.
    """
    kinds = {name: df.schema[name].dataType for name in attributes}

    def entry(place: int) -> Column:
        values = (
            (column(name) if i == place else F.lit(None).cast(kinds[name])).alias(f"v{i}")
            for i, name in enumerate(attributes)
        )
        return F.struct(F.lit(place).alias("attribute"), *values)

    timed = [] if time is None else [column(time).alias("time")]
    seen = [] if time is None else [F.min("time").alias("first"), F.max("time").alias("last")]
    names = [f"k{i}" for i in range(len(keys))]
    entries = df.select(
        *(column(key).alias(name) for key, name in zip(keys, names)),
        *timed,
        F.inline(F.array(*map(entry, range(len(attributes))))),
    )
    group = [F.col(name) for name in (*names, "attribute", *(f"v{i}" for i in range(len(attributes))))]
    # A single grouping set always shuffles partial counts. After a join on one of the keys
    # groupBy would not, and then Spark could not split the join of a hot key.
    return entries.groupingSets([group], *group).agg(F.count("*").alias("occurrences"), *seen)


def _value_of(place: int) -> Column:
    return F.when(F.col("attribute") == place, F.col(f"v{place}"))


def _grouped(counted: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    names = [f"k{i}" for i in range(len(keys))]
    rolled = counted.groupBy(*names).agg(*aggregates)
    renamed = [F.col(name).alias(key) for name, key in zip(names, keys)]
    return rolled.select(*renamed, *(column(c) for c in rolled.columns[len(names) :]))


def most_common_values(
    df: DataFrame, keys: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """Most frequent non-null value of each attribute per group; lowest on a tie."""
    return _grouped(
        _count_values(df, keys, attributes),
        keys,
        *(
            most_frequent(_value_of(i), F.col("occurrences")).alias(f"most_common_{name}")
            for i, name in enumerate(attributes)
        ),
    )


def event_rollup(
    events: DataFrame, keys: Sequence[str] = ("user_id", "partition_date")
) -> DataFrame:
    """Per group: events, sessions, usual device and type, first and last time."""
    counted = _count_values(
        events, keys, ["session_id", "device_type", "event_type"], "event_timestamp"
    )
    # Each event was counted once per attribute; any one of them gives the total.
    count = F.col("occurrences")
    return _grouped(
        counted,
        keys,
        F.sum(F.when(F.col("attribute") == 0, count)).alias("total_events"),
        F.count(_value_of(0)).alias("unique_sessions"),
        most_frequent(_value_of(1), count).alias("most_common_device"),
        most_frequent(_value_of(2), count).alias("most_common_event_type"),
        F.min("first").alias("first_event_timestamp"),
        F.max("last").alias("last_event_timestamp"),
    )


def purchase_rollup(
    purchases: DataFrame, amount_type: DataType | None = None, after_join: bool = False
) -> DataFrame:
    """Per user: purchases, total and average amount.

    Amounts add up as they are stored. An exact amount_type (a decimal) makes
    the totals independent of the order in which doubles happen to be added.

    after_join is for purchases that were just joined on user_id. groupBy would
    then add no shuffle, and Spark could not split the join of a hot user; a
    single grouping set gives the same rows but always shuffles partial sums.
    """
    user = F.col("user_id")
    grouped = purchases.groupingSets([[user]], user) if after_join else purchases.groupBy(user)
    amount = F.col("purchase_amount")
    if amount_type is not None:
        amount = amount.cast(amount_type)
    total = F.sum(amount).cast("double")
    return grouped.agg(
        F.count("*").alias("total_purchases"),
        total.alias("total_purchase_amount"),
        F.try_divide(total, F.count(amount)).alias("avg_purchase_amount"),
    )


def daily_activity(events: DataFrame, users: DataFrame, since: int) -> DataFrame:
    """Events and sessions per known user and day, from a date on.

    An inner join with the users on user_id, done after the rollup: each count
    is multiplied by the user's number of rows, as joining first would.
    """
    daily = (
        events.where(F.col("partition_date") >= since)
        .groupBy("user_id", "partition_date")
        .agg(
            F.count("*").alias("event_count"),
            F.countDistinct("session_id").alias("session_count"),
        )
    )
    known = users.groupBy("user_id").agg(F.count("*").alias("copies"))
    return daily.join(known, "user_id").select(
        "user_id",
        "partition_date",
        (F.col("event_count") * F.col("copies")).alias("event_count"),
        "session_count",
    )
