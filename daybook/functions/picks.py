"""Aggregates that pick one value of a group, with every tie settled.

Both keep a single candidate per group in the aggregation buffer, so they
combine before the shuffle and a group of any size costs one row per task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def earliest(value: str, order: str, tiebreak: Sequence[str] = ()) -> Column:
    """Value (possibly null) of the group's first row by order, then tiebreak."""
    return F.min_by(value, F.struct(order, *tiebreak))


def most_frequent(value: Column, occurrences: Column) -> Column:
    """Value with the most occurrences, the lowest one on a tie; nulls never win.

    For input already counted to one row per distinct value.
    """
    place = F.struct((-occurrences).alias("most_first"), value.alias("value"))
    return F.min(F.when(value.isNotNull(), place))["value"]
