"""Replacing missing values."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace null in each named column by its default, column by column."""
    return df.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    )


def fill_zero(df: DataFrame, *columns: str) -> DataFrame:
    """Null (and, in floating columns, NaN) becomes 0; column types stay."""
    return df.fillna(0, subset=list(columns))
