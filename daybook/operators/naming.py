"""Column names that can't clash with those of a caller's table."""

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh_name(base: str, taken: Iterable[str]) -> str:
    """base, with as many underscores behind it as make it new under any case rule."""
    lowered = {name.lower() for name in taken}
    while base.lower() in lowered:
        base += "_"
    return base
