"""Exact deduplication that a group of any size cannot overload.

Equal texts are combined in three steps, each comparing whole texts next to
their digests: within each map task (Spark's partial aggregation), then within
each digest and salt, then over the salts of a digest. Only DataFrame
functions are used.

Rows are texts of documents; a null text counts as empty. Of equal texts the
row with the largest doc_id stays; a null doc_id is smaller than any other. An
empty table gives an empty result. Further columns, of any name, are allowed.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import column, packed, stored, text_of, unpacked

SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _salted(rows: DataFrame, salts: int, *aggregates: Column) -> DataFrame:
    # The salt is the same throughout a map task, so copies combine before the
    # shuffle; over all tasks, a digest goes to at most `salts` groups.
    salt = F.pmod(F.spark_partition_id(), F.lit(salts))
    return rows.groupBy("digest", salt.alias("salt"), "text").agg(*aggregates)


def exact_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """Per row: doc_id, keep_id (that of the row that stays), group_size, kept, text_sha256.

    Rows that repeat both text and doc_id are one document listed twice: each is
    counted in group_size, and they share the decision. Digests only route rows:
    texts that share a digest are told apart, at the price of one more pass over
    the rows of such digests.
    """
    rows = docs.select(column(doc_id).alias("id"), text_of(text).alias("text")).select(
        "id", "text", digest(F.col("text")).alias("digest")
    )
    salted = _salted(rows, salts, F.max("id").alias("last"), F.count("*").alias("copies"))
    texts = salted.groupBy("digest", "text").agg(
        F.max("last").alias("keep_id"), F.sum("copies").alias("group_size")
    )
    winners = stored(
        texts.groupBy("digest").agg(
            F.count("*").alias("texts"),
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
        )
    )
    ids = rows.select("id", "digest", F.sha2("text", 256).alias("sha"))
    decided = ids.join(winners.where("texts = 1").drop("texts"), "digest").drop("digest")
    ambiguous = winners.where("texts > 1").select("digest")
    if not ambiguous.isEmpty():
        unclear = rows.join(ambiguous, "digest", "left_semi")
        exact = unclear.groupBy("digest", "text").agg(
            F.max("id").alias("keep_id"), F.count("*").alias("group_size")
        )
        decided = decided.unionByName(
            unclear.join(exact, ["digest", "text"]).select(
                "id", F.sha2("text", 256).alias("sha"), "keep_id", "group_size"
            )
        )
    return decided.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = SALTS
) -> DataFrame:
    """The rows that stay, with all their columns; exactly one per distinct text.

    The other columns of the best row so far travel with its text, so the rows
    need not be joined again. Of rows that repeat text and doc_id one stays.
    """
    others = [name for name in docs.columns if name != text]
    rows = docs.select(
        text_of(text).alias("text"),
        F.struct(
            column(text).isNull().alias("missing"), packed(others).alias("others")
        ).alias("row"),
        F.struct(column(doc_id).isNotNull().alias("known"), column(doc_id).alias("id")).alias(
            "place"
        ),
    ).withColumn("digest", sha256(F.col("text")))
    best = F.max_by("row", "place").alias("row"), F.max("place").alias("place")
    kept = _salted(rows, salts, *best).groupBy("digest", "text").agg(*best)
    original = F.when(~F.col("row.missing"), F.col("text")).alias(text)
    restored = dict(zip(others, unpacked(others, "row.others")))
    return kept.select(*(original if name == text else restored[name] for name in docs.columns))
