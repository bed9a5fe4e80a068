"""Helpers shared by the operators of this package."""

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daybook.scratch import new_path

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """A text column, null read as empty."""
    return F.coalesce(column(name), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, _UPPER, _UPPER.lower())


def scratch_path(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share."""
    return new_path(spark, "daybook_llm")


_shipped: set[str] = set()


def ship_library(spark: SparkSession) -> None:
    """Have executors import this library, wherever the driver found it.

    Operators call this before they run Python on executors; once per application.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        name = f"{tempfile.mkdtemp(prefix='daybook-code-')}/daybook"
        context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def stored(df: DataFrame) -> DataFrame:
    """df, computed once and written to the shared folder.

    Later steps read the files, so a lost executor costs only its own tasks.
    Compressed columns take far less space there than a checkpoint of rows.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(columns: list[str]) -> Column:
    """The columns as one struct, under names that can't clash with any other."""
    return F.struct(*(column(name).alias(f"c{i}") for i, name in enumerate(columns)))


def unpacked(columns: list[str], struct: str) -> list[Column]:
    return [F.col(struct)[f"c{i}"].alias(name) for i, name in enumerate(columns)]


def bounded_sample(rows: DataFrame, size: int) -> DataFrame:
    """About `size` of the stored rows, spread by a hash, and never more than twice as many.

    Unlike the first of a sorted order this sends no more than that to the driver, however
    many tasks there are.
    """
    every = max(1, -(-rows.count() // size))
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(every)) == 0
    return rows.where(spread).limit(2 * size)
