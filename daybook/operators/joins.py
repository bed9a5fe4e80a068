"""Left-join enrichment and attaching rollups."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from daybook.functions import fill_zero, with_defaults
from daybook.operators.naming import column, fresh_name


def usable_lookup(lookup: DataFrame, lookup_filter: Column | str | None) -> DataFrame:
    """The entries that count; the others are as good as missing."""
    return lookup if lookup_filter is None else lookup.where(lookup_filter)


def enrich_left(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    defaults: Mapping[str, object],
    lookup_filter: Column | str | None = None,
) -> DataFrame:
    """Add the lookup's columns named in defaults; missing values get the default.

    The filter applies to the lookup before the join, so a filtered-out entry
    counts as missing and the fact row stays. A key with several lookup rows
    repeats its fact rows, once per lookup row. No join hint: Spark broadcasts a
    lookup it has measured to be small and otherwise splits skewed fact keys at
    run time.
    """
    columns = usable_lookup(lookup, lookup_filter).select(key, *defaults)
    return with_defaults(facts.join(columns, key, "left"), defaults)


def enrich_left_spread(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    defaults: Mapping[str, object],
    lookup_filter: Column | str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """enrich_left for a key that may be hot in the facts, in the lookup, or in both.

    A key with more than its part of the fact rows (1 / parts, by default the number of
    shuffle partitions) is dealt over as many cells as the parts it would fill, and its
    lookup rows are repeated in each. A cell then holds about one part of fact rows, so no
    task has a whole hot key, with or without adaptive execution. The rows are those of
    enrich_left: null keys match nothing but are spread as well, empty and missing keys
    are ordinary, and repeated rows stay.

    Costs one count of the facts per key, of the key column alone and combined before its
    shuffle; facts that are costly to compute are better stored first. Fewer than parts
    keys can be hot, so their list may be broadcast.
    """
    if parts is None:
        parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if parts < 1:
        raise ValueError("the number of parts has to be positive")
    columns = usable_lookup(lookup, lookup_filter).select(key, *defaults)
    taken = [*facts.columns, *columns.columns]
    cell, cells, hot_key = (fresh_name(name, taken) for name in ("_cell", "_cells", "_hot_key"))
    counts = facts.groupBy(column(key).alias(hot_key)).agg(F.count("*").alias(cells))
    total = counts.agg(F.sum(cells)).scalar()
    hot = F.broadcast(
        counts.where(F.col(cells) * parts > total).select(
            hot_key, F.ceil(F.col(cells) * parts / total).cast("int").alias(cells)
        )
    )

    def with_cells(df: DataFrame) -> DataFrame:
        matched = df.join(hot, column(key).eqNullSafe(F.col(hot_key)), "left").drop(hot_key)
        return matched.withColumn(cells, F.coalesce(cells, F.lit(1)))

    # A row's cell depends on what it holds and on its partition, not on its place there,
    # so a task that runs again deals its rows alike, and copies still spread.
    content = [column(f.name) for f in facts.schema if "map<" not in f.dataType.simpleString()]
    dealt = F.pmod(F.xxhash64(*content, F.spark_partition_id()), F.col(cells)).cast("int")
    spread = with_cells(facts).withColumn(cell, dealt).drop(cells)
    each = F.explode(F.sequence(F.lit(0), F.col(cells) - 1))
    repeated = with_cells(columns).withColumn(cell, each).drop(cells)
    joined = spread.join(repeated, [key, cell], "left").drop(cell)
    return with_defaults(joined, defaults)


def lookup_groups(
    lookup: DataFrame,
    key: str,
    defaults: Mapping[str, object],
    lookup_filter: Column | str | None = None,
    count_column: str = "copies",
) -> DataFrame:
    """Lookup reduced to its distinct (key, attributes), counted in count_column.

    Joining a rollup to these and multiplying its counts gives what enriching every
    fact row first would give, without moving the fact rows.
    """
    if count_column in (key, *defaults):
        raise ValueError(f"{count_column!r} is a column of the lookup; name the count otherwise")
    filled = with_defaults(usable_lookup(lookup, lookup_filter).select(key, *defaults), defaults)
    return filled.groupBy(key, *defaults).agg(F.count("*").alias(count_column))


def attach_rollup(base: DataFrame, rollup: DataFrame, key: str) -> DataFrame:
    """Left join of a second rollup by key; its columns are 0 where it has no row.

    A key with several base rows repeats the attached totals on each of them,
    and keys found only in the rollup do not appear.
    """
    attached = [name for name in rollup.columns if name != key]
    return fill_zero(base.join(rollup, key, "left"), *attached)
