"""Declared table contracts.

Field groups that several tables share are written once and concatenated, so a
column keeps one name and one type from the source to the summary. The names and types
are fixed values: they are the data's contract.
"""

from pyspark.sql import types as T


def _fields(**types: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, data_type, True) for name, data_type in types.items()]


USER_KEY = _fields(user_id=T.StringType())
DATE_KEY = _fields(partition_date=T.IntegerType())  # YYYYMMDD
RANK = _fields(row_number=T.LongType())

EVENT = _fields(
    event_id=T.StringType(),
    event_type=T.StringType(),
    event_timestamp=T.TimestampType(),
    session_id=T.StringType(),
    page_url=T.StringType(),
    device_type=T.StringType(),
)
TRANSACTION = _fields(
    transaction_id=T.StringType(),
    product_id=T.StringType(),
    purchase_amount=T.DoubleType(),
    purchase_timestamp=T.TimestampType(),
    payment_method=T.StringType(),
    currency=T.StringType(),
    is_refunded=T.BooleanType(),
)
PROFILE = _fields(
    username=T.StringType(),
    age_group=T.StringType(),
    country=T.StringType(),
    subscription_tier=T.StringType(),
)
PROFILE_DETAILS = _fields(
    email=T.StringType(),
    registration_date=T.TimestampType(),
    is_active=T.BooleanType(),
)
SUMMARY_METRICS = _fields(
    total_events=T.LongType(),
    unique_sessions=T.LongType(),
    total_purchases=T.LongType(),
    total_purchase_amount=T.DoubleType(),
    avg_purchase_amount=T.DoubleType(),
    most_common_device=T.StringType(),
    most_common_event_type=T.StringType(),
    first_event_timestamp=T.TimestampType(),
    last_event_timestamp=T.TimestampType(),
)

USER_EVENT = T.StructType(EVENT + USER_KEY + DATE_KEY)
PURCHASE = T.StructType(TRANSACTION + USER_KEY + DATE_KEY)
USER_PROFILE = T.StructType(USER_KEY + PROFILE + PROFILE_DETAILS)
RANKED_USER_EVENT = T.StructType(USER_EVENT.fields + RANK)
RANKED_PURCHASE = T.StructType(PURCHASE.fields + RANK)
ENRICHED_USER_EVENT = T.StructType(USER_EVENT.fields + PROFILE)
ENRICHED_PURCHASE = T.StructType(PURCHASE.fields + PROFILE)
USER_ACTIVITY_SUMMARY = T.StructType(USER_KEY + DATE_KEY + PROFILE + SUMMARY_METRICS)

# What an event or purchase shows where its user's profile, or a
# field of it, is missing.
PROFILE_DEFAULTS = {
    "username": "unknown",
    "age_group": "unknown",
    "country": "unknown",
    "subscription_tier": "free",
}
