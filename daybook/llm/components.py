"""Connected components of a graph given as links, by alternating star steps.

In a large-star step every node sends its larger neighbours to the smallest node it
knows, in a small-star step its smaller ones. Both keep the components, and after
a few rounds every node points to the smallest of its own. A round is two groupings
and two joins, so a node with very many links is never gathered in one place.
"""

from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    neighbours = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return neighbours.unionByName(own).where("a <> b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(links: DataFrame) -> DataFrame:
    """(a, b) for every linked node a that is not the smallest, b, of its component.

    links has columns a and b, of any type with an order; links of a node to itself
    are ignored. Each round is written to the shared folder, so the plan stays short.
    """
    links = stored(links.where("a <> b").select("a", "b").distinct())
    before = _state(links)
    while True:
        links = stored(_small_star(_large_star(links)))
        after = _state(links)
        if after == before:
            return links
        before = after
