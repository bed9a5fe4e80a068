"""Validated table writes: plain, partitioned and sized by file.

mode is Spark's: overwrite, append, error or ignore. With a path the table is
external, stored there; without one it goes to the session's warehouse.
"""

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from itertools import accumulate
from threading import RLock

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from daybook.operators.conform import conform
from daybook.scratch import scratch_folder
from daybook.sources import check_table_name


class TableWriteError(RuntimeError):
    """A table could not be written."""


def _check(df: DataFrame, name: str) -> None:
    if df is None:
        raise ValueError("there is no frame to write")
    check_table_name(name)


def _save(
    df: DataFrame,
    name: str,
    mode: str,
    path: str | None,
    partition_columns: Sequence[str] = (),
    compression: str = "snappy",
) -> None:
    writer = df.write.mode(mode).option("compression", compression)
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    if path is not None:
        writer = writer.option("path", path)
    try:
        writer.saveAsTable(name)
    except PySparkException as error:
        raise TableWriteError(f"cannot write table {name!r}, mode {mode}: {error}") from error


def write_table(
    df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None
) -> None:
    _check(df, name)
    _save(df, name, mode, path)


def write_typed(
    df: DataFrame,
    name: str,
    schema: StructType,
    mode: str = "overwrite",
    path: str | None = None,
) -> None:
    """Conform to the declared schema, then write."""
    _check(df, name)
    _save(conform(df, schema), name, mode, path)


def write_partitioned(
    df: DataFrame,
    name: str,
    partition_columns: Sequence[str],
    mode: str = "overwrite",
    path: str | None = None,
    cluster: bool = True,
) -> None:
    """Write one directory per partition value; a filter on it prunes the read.

    Rows are first brought together by partition value, so that not every task
    writes a file into every directory. This is a rebalance, not a repartition:
    a value with too many rows for one task is spread over several, at run time.
    cluster=False skips that shuffle, for input already laid out this way. The
    partition columns come last in the table.
    """
    _check(df, name)
    if not partition_columns or not all(partition_columns):
        raise ValueError("partition columns must be a non-empty list of non-empty names")
    unknown = [column for column in partition_columns if column not in df.columns]
    if unknown:
        raise ValueError(f"partition columns {unknown} are not in the frame")
    if not cluster:
        _save(df, name, mode, path, partition_columns)
        return
    df = df.hint("rebalance", *(F.col(column) for column in partition_columns))
    # Only adaptive execution splits a large value.
    with _session_settings(df.sparkSession, {"spark.sql.adaptive.enabled": "true"}):
        _save(df, name, mode, path, partition_columns)


def write_typed_partitioned(
    df: DataFrame,
    name: str,
    schema: StructType,
    partition_columns: Sequence[str],
    mode: str = "overwrite",
    path: str | None = None,
) -> None:
    """Conform to the declared schema, then write partitioned."""
    _check(df, name)
    write_partitioned(conform(df, schema), name, partition_columns, mode, path)


_TURN = RLock()


@contextmanager
def _session_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings for one write; writers in other threads wait until they are undone."""
    with _TURN:
        before = {key: spark.conf.get(key, None) for key in settings}
        try:
            for key, value in settings.items():
                spark.conf.set(key, value)
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)


# Row groups of the first copy per target: the bounds of files fall between row groups.
_GROUPS_PER_FILE = 4
# Files of the first copy that the trial may list; it stops at the target's size.
_TRIAL_FILES = 1000


def write_compact(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    target_file_mb: float = 128,
    path: str | None = None,
) -> None:
    """Write files of about the target size, in one run of the plan.

    The plan's rows are stored once as compressed columns, so that their size in files is
    measured and not guessed, and are written again from there without a shuffle: the
    second scan merges small files and splits large ones between row groups, by bytes.
    Merging makes columns compress better. A trial writes small files of one target's
    size as one file, and the share of bytes it saves is allowed for. The sizing settings
    hold for the whole session during the write. Writers of this module take turns with
    them; other queries of the session should wait.
    """
    _check(df, name)
    if target_file_mb <= 0:
        raise ValueError("the size of files has to be positive")
    spark = df.sparkSession
    if mode in ("ignore", "error", "errorifexists") and spark.catalog.tableExists(name):
        # Nothing will be written: don't run the plan.
        _save(df, name, mode, path)
        return
    target = target_file_mb * 1024 * 1024
    with scratch_folder(spark) as folder:
        groups = max(1, round(target / _GROUPS_PER_FILE))
        try:
            df.write.option("parquet.block.size", groups).parquet(f"{folder}/rows")
        except PySparkException as error:
            raise TableWriteError(f"cannot store the rows of table {name!r}: {error}") from error
        share = _merged_share(spark, folder, target)
        sizing = {
            "spark.sql.files.maxPartitionBytes": str(max(1, round(target / share))),
            "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1",
        }
        with _session_settings(spark, sizing):
            _save(_stored_rows(spark, df.schema, f"{folder}/rows"), name, mode, path)


def _stored_rows(spark: SparkSession, schema: StructType, *paths: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths)


def _file_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """path and length of a folder's files, from its listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    return files.select("path", "length")


def _merged_share(spark: SparkSession, folder: str, target: float) -> float:
    """Bytes of the stored rows after small files are merged, as a share of those before."""
    sizes = _file_sizes(spark, f"{folder}/rows")
    small = F.col("length") < target
    total, in_small = sizes.agg(
        F.sum("length"), F.sum(F.when(small, F.col("length")).otherwise(0))
    ).first()
    if not in_small:
        return 1.0
    # A hash of the path picks files from anywhere in the folder.
    some = sizes.where(small).orderBy(F.xxhash64("path")).limit(_TRIAL_FILES).collect()
    before = list(accumulate(row.length for row in some))
    paths = [row.path for row, size in zip(some, before) if size <= target] or [some[0].path]
    rows = spark.read.parquet(*paths)
    rows.coalesce(1).write.parquet(f"{folder}/trial")
    merged = _file_sizes(spark, f"{folder}/trial").agg(F.sum("length")).first()[0]
    saved = 1 - merged / before[len(paths) - 1]
    return 1 - saved * in_small / total
