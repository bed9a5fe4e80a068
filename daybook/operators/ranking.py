"""Recency ranking and latest-row deduplication."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NullType

from daybook.operators.naming import column, fresh_name
from daybook.scratch import new_table


def _newest_first(order: str, tiebreak: Sequence[str]) -> list[Column]:
    return [column(order).desc_nulls_last(), *(column(name) for name in tiebreak)]


def keep_latest(
    df: DataFrame, keys: Sequence[str], order: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The newest row of each key; null is an ordinary key value.

    The rank filter sits directly on the window, so Spark keeps one row per key
    in each map task before the shuffle: a key with a third of all rows sends
    one row per task, however large it is.
    """
    rank = fresh_name("_rank", df.columns)
    window = Window.partitionBy(*map(column, keys)).orderBy(*_newest_first(order, tiebreak))
    ranked = df.withColumn(rank, F.row_number().over(window))
    return ranked.where(column(rank) == 1).drop(rank)


def rank_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tiebreak: Sequence[str] = (),
    rank_column: str = "row_number",
) -> DataFrame:
    """Every row, with its rank (1 = newest) among the rows of its key.

    All rows are sorted into range partitions, chunks, by key and then from new to
    old. A key may fill many chunks, so none is too large for a task. A row's rank is
    its rank within its chunk plus its key's rows in earlier chunks, and only the
    first key of a chunk can have any: the offsets are one row per chunk.

    The chunks are written at the call, as a second sampling pass would draw other bounds:
    once, as compressed columns, in buckets by chunk. Ranking within them needs no further
    shuffle, and the offsets read the keys alone. A row id spreads exact copies over
    chunks. The row travels in one struct, so its columns may have any names. Where only the
    newest row is wanted, keep_latest is cheaper.
    """
    spark = df.sparkSession
    scratch = new_table(spark)
    # A column without a type can't be stored, and has nothing to store.
    typed = [f.name for f in df.schema if not isinstance(f.dataType, NullType)]
    newest_first = [F.col("at").desc_nulls_last(), *(F.col(f"tie{i}") for i in range(len(tiebreak)))]
    rows = df.select(
        F.struct(*(column(name).alias(f"c{i}") for i, name in enumerate(typed))).alias("row"),
        F.struct(*(column(name).alias(f"k{i}") for i, name in enumerate(keys))).alias("key"),
        column(order).alias("at"),
        *(column(name).alias(f"tie{i}") for i, name in enumerate(tiebreak)),
        F.monotonically_increasing_id().alias("id"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        rows.repartitionByRange(parts, "key", *newest_first, "id")
        .drop("id")
        .withColumn("chunk", F.spark_partition_id())
        .write.bucketBy(parts, "chunk")
        .saveAsTable(**scratch)
    )
    chunks = spark.table(scratch["name"])
    # Within a chunk all rows of a key are together: no group exceeds a chunk.
    within = Window.partitionBy("chunk", "key").orderBy(*newest_first)
    ranked = chunks.select("row", "key", "chunk", F.row_number().over(within).alias("within"))
    # From here on one row per chunk, with two keys: as many rows as the cluster has
    # shuffle partitions, whatever the data, so they may be broadcast.
    bounds = chunks.groupBy("chunk").agg(
        F.min("key").alias("first_key"), F.max("key").alias("last_key")
    )
    ends = (
        chunks.select("chunk", "key")
        .join(F.broadcast(bounds), "chunk")
        .where("key = last_key")
        .groupBy("chunk", "first_key", "last_key")
        .agg(F.count("*").alias("rows"))
    )
    same_end = Window.partitionBy("last_key").orderBy("chunk")
    in_order = Window.orderBy("chunk")
    counted = ends.withColumn("rows_until", F.sum("rows").over(same_end))
    before = F.when(
        F.lag("last_key").over(in_order) == F.col("first_key"), F.lag("rows_until").over(in_order)
    )
    offsets = counted.select("chunk", "first_key", F.coalesce(before, F.lit(0)).alias("offset"))
    offset = F.when(F.col("key") == F.col("first_key"), F.col("offset")).otherwise(0)
    return ranked.join(F.broadcast(offsets), "chunk").select(
        *(
            F.col(f"row.c{typed.index(name)}").alias(name) if name in typed else F.lit(None).alias(name)
            for name in df.columns
        ),
        (F.col("within") + offset).cast("long").alias(rank_column),
    )
