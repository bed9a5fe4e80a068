"""Small frames in the declared schemas."""

from datetime import datetime, timedelta, timezone

from daybook.schemas import PURCHASE, USER_EVENT, USER_PROFILE

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def at(milliseconds):
    return EPOCH + timedelta(milliseconds=milliseconds)


def _rows(schema, defaults, rows):
    return [tuple({**defaults, **row}[name] for name in schema.names) for row in rows]


def event_rows(*rows):
    defaults = {
        "event_id": "1",
        "event_type": "click",
        "event_timestamp": at(320),
        "session_id": "morning",
        "page_url": "/start",
        "device_type": "watch",
        "user_id": "nr-11",
        "partition_date": 20240101,
    }
    return _rows(USER_EVENT, defaults, rows)


def events(spark, *rows):
    return spark.createDataFrame(event_rows(*rows), USER_EVENT)


def purchases(spark, *rows):
    defaults = {
        "transaction_id": "t1",
        "product_id": "lamp",
        "purchase_amount": 42.5,
        "purchase_timestamp": at(320),
        "payment_method": "card",
        "currency": "USD",
        "is_refunded": False,
        "user_id": "nr-11",
        "partition_date": 20240101,
    }
    return spark.createDataFrame(_rows(PURCHASE, defaults, rows), PURCHASE)


def profiles(spark, *rows):
    defaults = {
        "user_id": "nr-11",
        "username": "ines",
        "age_group": "18-24",
        "country": "PT",
        "subscription_tier": "gold",
        "email": "ines@mail.example",
        "registration_date": at(90),
        "is_active": True,
    }
    return spark.createDataFrame(_rows(USER_PROFILE, defaults, rows), USER_PROFILE)


INES = {}
TOMAS = {
    "user_id": "nr-22",
    "username": "tomas",
    "age_group": "45+",
    "country": "CZ",
    "subscription_tier": "silver",
}
YUKI = {"user_id": "nr-33", "username": "yuki", "country": "JP", "is_active": False}
