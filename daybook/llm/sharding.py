"""Contiguous shards of nearly equal bytes, from prefix sums of partition totals.

Rows are put in one global order by range partitioning. Each partition reports
its bytes and rows; prefix sums over these few totals give every partition its
offset, and running sums within the partitions place every row. Equal cuts of
the byte axis are the shards.
"""

from pyspark.sql import DataFrame, Window, functions as F

from daybook.llm.common import column, stored, text_of

RECORD_OVERHEAD = 8


def byte_shards(
    docs: DataFrame,
    shards: int = 24,
    doc_id: str = "doc_id",
    text: str = "text",
    overhead: int = RECORD_OVERHEAD,
) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law `bytes`: a shard's bytes differ from the mean by less than one row at
    either cut. size is the text's UTF-8 bytes plus overhead (null: none).
    A row belongs to the shard that holds the middle of its bytes, so a row larger
    than a shard may leave a shard empty. Rows are ordered by a hash of the text,
    then doc_id: equal texts are neighbours and share a shard unless a cut falls
    between them, and a group of any size is spread over tasks and shards. slot
    counts from 0 within a shard. Rows may repeat; each gets its own slot. An
    empty table gives an empty result. Other columns are ignored.
    """
    rows = docs.select(
        column(doc_id).alias("doc_id"),
        (F.octet_length(text_of(text)) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text_of(text).cast("binary")).alias("text_crc32"),
        F.xxhash64(text_of(text)).alias("place"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["place", "doc_id", "row"]
    # Stored: a second run of the sampling behind the ranges could cut elsewhere.
    pieces = stored(rows.repartitionByRange(*order).withColumn("piece", F.spark_partition_id()))
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    all_pieces = Window.partitionBy()
    # One row per partition: a number set by the cluster's settings, not by the data.
    offsets = (
        pieces.groupBy("piece")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .select(
            "piece",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(all_pieces).alias("total"),
        )
    )
    within = Window.partitionBy("piece").orderBy(*order)
    until = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        pieces.withColumn("bytes_until", F.sum("size").over(until))
        .withColumn("rows_until", F.row_number().over(within))
        .join(offsets, "piece")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            (F.col("rows_before") + F.col("rows_until") - 1).alias("position"),
            F.expr(
                f"int(((2 * (bytes_before + bytes_until) - size) * {shards}) div (2 * total))"
            ).alias("shard"),
        )
    )
    firsts = placed.groupBy("shard").agg(F.min("position").alias("first"))
    return placed.join(firsts, "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("position") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
