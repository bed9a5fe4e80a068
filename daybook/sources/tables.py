"""Lazy, validated table scans."""

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from daybook.operators.conform import SchemaMismatch, conform


class TableReadError(RuntimeError):
    """A table could not be read as asked."""


def check_table_name(name: str) -> None:
    if not name:
        raise ValueError("table name is missing or empty")
    if name != name.strip():
        raise ValueError(f"table name {name!r} has outer whitespace")
    if " " in name:
        raise ValueError(f"table name {name!r} contains a space")


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Table by name; nothing is read until an action."""
    check_table_name(name)
    try:
        return spark.table(name)
    except PySparkException as error:
        raise TableReadError(f"cannot read table {name!r}: {error}") from error


def scan_typed(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """Table conformed to a declared schema."""
    table = scan_table(spark, name)
    try:
        return conform(table, schema)
    except SchemaMismatch as error:
        raise TableReadError(f"table {name!r} does not fit its schema: {error}") from error


def scan_columns(spark: SparkSession, name: str, columns: Sequence[str]) -> DataFrame:
    """Only the named columns; the file scan reads no others."""
    if not columns or not all(columns):
        raise ValueError("columns must be a non-empty list of non-empty names")
    table = scan_table(spark, name)
    try:
        return table.select(*columns)
    except PySparkException as error:
        raise TableReadError(
            f"cannot read columns {list(columns)} of table {name!r}: {error}"
        ) from error
