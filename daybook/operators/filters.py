"""Row filters. All are plain column predicates, so they reach the scan."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F


def filter_between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows with low <= column <= high; low > high leaves none."""
    return df.where(F.col(column).between(low, high))


def require_not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(reduce(and_, (F.col(name).isNotNull() for name in columns)))


def exclude_flagged(df: DataFrame, flag: str) -> DataFrame:
    """Rows whose flag is false; a null flag drops the row too."""
    return df.where(~F.col(flag))


def keep_positive(df: DataFrame, column: str) -> DataFrame:
    """Rows with column > 0; null, zero and negative drop."""
    return df.where(F.col(column) > 0)
