"""Scans and writes: validation, save modes, layout on disk."""

import re
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from daybook.queries.inputs import table, table_name
from daybook.scratch import ensure_checkpoint_dir
from daybook.sinks import (
    TableWriteError,
    write_compact,
    write_partitioned,
    write_table,
    write_typed,
    write_typed_partitioned,
)
from daybook.sources import TableReadError, scan_columns, scan_table, scan_typed

SF_DIR = "/root/testdata/sf0.001"
BAD_NAMES = [None, "", " t", "t ", "\tt", "a b"]
PAIR = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def numbers(spark, low, high, parts=1):
    return spark.range(low, high, 1, parts).select("id", (F.col("id") % 3).alias("v"))


def ids(df):
    return sorted(row.id for row in df.collect())


@pytest.mark.parametrize("name", BAD_NAMES)
def test_bad_names_are_refused_before_anything_runs(spark, name):
    df = numbers(spark, 0, 1)
    for call in (
        lambda: scan_table(spark, name),
        lambda: scan_typed(spark, name, PAIR),
        lambda: scan_columns(spark, name, ["id"]),
        lambda: write_table(df, name),
        lambda: write_typed(df, name, PAIR),
        lambda: write_partitioned(df, name, ["v"]),
        lambda: write_typed_partitioned(df, name, PAIR, ["v"]),
        lambda: write_compact(df, name),
    ):
        with pytest.raises(ValueError, match="table name"):
            call()


def test_bad_arguments_are_refused(spark):
    df = numbers(spark, 0, 1)
    for columns in ([], [""], ["id", ""]):
        with pytest.raises(ValueError, match="columns"):
            scan_columns(spark, "t", columns)
        with pytest.raises(ValueError, match="columns"):
            write_partitioned(df, "t", columns)
    with pytest.raises(ValueError, match="not in the frame"):
        write_partitioned(df, "t", ["V"])
    for size in (0, -1):
        with pytest.raises(ValueError, match="positive"):
            write_compact(df, "t", target_file_mb=size)
    with pytest.raises(ValueError, match="no frame"):
        write_table(None, "t")


def test_read_failures_name_the_table(spark):
    with pytest.raises(TableReadError, match="no_such_table"):
        scan_table(spark, "no_such_table")
    with pytest.raises(RuntimeError, match="no_such_table"):
        scan_typed(spark, "no_such_table", PAIR)
    orders = table_name(SF_DIR, "orders")
    with pytest.raises(TableReadError, match="o_missing"):
        scan_columns(spark, orders, ["o_orderkey", "o_missing"])
    narrower = T.StructType([T.StructField("o_orderkey", T.IntegerType())])
    with pytest.raises(TableReadError, match="does not widen"):
        scan_typed(spark, orders, narrower)


def test_scan_of_a_temporary_view(spark):
    numbers(spark, 0, 3).createOrReplaceTempView("three_numbers")
    assert ids(scan_table(spark, "three_numbers")) == [0, 1, 2]
    assert scan_columns(spark, "three_numbers", ["v"]).columns == ["v"]


def test_save_modes(spark):
    write_table(numbers(spark, 0, 3), "modes")
    write_table(numbers(spark, 3, 5), "modes", mode="append")
    assert ids(scan_table(spark, "modes")) == [0, 1, 2, 3, 4]
    write_table(numbers(spark, 9, 10), "modes", mode="ignore")
    assert ids(scan_table(spark, "modes")) == [0, 1, 2, 3, 4]
    with pytest.raises(TableWriteError, match="'modes', mode error"):
        write_table(numbers(spark, 9, 10), "modes", mode="error")
    write_table(numbers(spark, 7, 9), "modes")
    assert ids(scan_table(spark, "modes")) == [7, 8]


def test_append_matches_columns_by_name(spark):
    write_table(spark.createDataFrame([(1, 2)], "a int, b int"), "by_name")
    write_table(spark.createDataFrame([(4, 3)], "b int, a int"), "by_name", mode="append")
    assert sorted(map(tuple, scan_table(spark, "by_name").collect())) == [(1, 2), (3, 4)]


def test_a_table_being_read_is_not_overwritten(spark):
    write_table(numbers(spark, 0, 3), "self")
    with pytest.raises(TableWriteError, match="self"):
        write_table(scan_table(spark, "self"), "self")
    assert ids(scan_table(spark, "self")) == [0, 1, 2]


def test_typed_writes_conform(spark):
    write_typed(numbers(spark, 0, 3), "typed", PAIR)
    assert scan_table(spark, "typed").dtypes == [("id", "bigint"), ("v", "string")]
    write_typed_partitioned(numbers(spark, 0, 3), "typed_parts", PAIR, ["v"])
    back = scan_typed(spark, "typed_parts", PAIR)
    assert back.columns == PAIR.names
    assert sorted(map(tuple, back.collect())) == [(0, "0"), (1, "1"), (2, "2")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitioned_write_lays_out_and_prunes(spark, tmp_path):
    df = numbers(spark, 0, 3000, parts=8)
    write_partitioned(df, "parts", ["v"], path=str(tmp_path / "parts"))
    stored = scan_table(spark, "parts")
    assert stored.columns == ["id", "v"]
    # Clustered: one file per value although eight tasks held rows of each.
    files = sorted(p.parent.name for p in (tmp_path / "parts").glob("v=*/*.parquet"))
    assert files == ["v=0", "v=1", "v=2"]
    one = stored.where("v = 1")
    assert one.count() == 1000
    assert "InMemoryFileIndex(1 paths)" in plan(one)
    write_partitioned(df, "loose", ["v"], path=str(tmp_path / "loose"), cluster=False)
    assert len(list((tmp_path / "loose").glob("v=*/*.parquet"))) == 24
    assert ids(scan_table(spark, "loose")) == ids(df)


def test_a_large_partition_value_is_split_over_tasks(spark, tmp_path):
    """Two thirds of the rows share one value; it must not be one task's work."""
    df = spark.range(0, 3_000_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 30).otherwise(-1).alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16MB")
    try:
        write_partitioned(df, "skewed", ["v"], path=str(tmp_path / "skewed"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "skewed" / "v=-1").glob("*.parquet"))) > 3
    assert scan_table(spark, "skewed").count() == 3_000_000


def parquet_files(path: Path):
    return [p.stat().st_size for p in path.glob("*.parquet")]


def test_compact_write_merges_and_splits(spark, tmp_path):
    settings = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(key) for key in settings]
    lineitem = table(spark, "/root/testdata/sf0.1", "lineitem")
    write_compact(lineitem.repartition(50), "merged", path=str(tmp_path / "merged"))
    assert len(parquet_files(tmp_path / "merged")) == 1
    write_compact(
        lineitem.repartition(8), "split", target_file_mb=1, path=str(tmp_path / "split")
    )
    assert scan_table(spark, "split").count() == lineitem.count()
    assert [spark.conf.get(key) for key in settings] == before
    with pytest.raises(TableWriteError):
        write_compact(lineitem, "split", mode="error", path=str(tmp_path / "split"))
    assert [spark.conf.get(key) for key in settings] == before


@pytest.mark.parametrize("parts", [1, 8, 200])
@pytest.mark.parametrize("name, target", [("lineitem", 1), ("documents", 1), ("events", 0.25)])
def test_compact_files_have_the_target_size_whatever_the_table(spark, tmp_path, name, target, parts):
    """Numbers, long texts and short strings; from one large part, some, and many small ones."""
    rows = table(spark, "/root/testdata/sf0.1", name).repartition(parts)
    made = f"sized_{name}_{parts}"
    write_compact(rows, made, target_file_mb=target, path=str(tmp_path / made))
    sizes = sorted(parquet_files(tmp_path / made))
    assert len(sizes) > 3
    assert 0.75 <= sizes[len(sizes) // 2] / 1024 / 1024 / target <= 1.25

    def digest(df):
        hashes = F.xxhash64(*df.columns).cast("decimal(38,0)")
        return df.agg(F.count("*"), F.sum(hashes)).first()

    assert digest(scan_table(spark, made)) == digest(rows)


def test_compact_write_keeps_modes_and_empty_frames(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def counted(rows):
        runs.add(1)
        return rows

    write_compact(numbers(spark, 0, 0), "compact_modes", path=str(tmp_path / "modes"))
    assert scan_table(spark, "compact_modes").columns == ["id", "v"]
    write_compact(numbers(spark, 0, 3), "compact_modes", mode="append")
    write_compact(numbers(spark, 3, 5), "compact_modes", mode="append")
    assert ids(scan_table(spark, "compact_modes")) == [0, 1, 2, 3, 4]
    costly = spark.createDataFrame(numbers(spark, 9, 12).rdd.mapPartitions(counted), "id long, v long")
    write_compact(costly, "compact_modes", mode="ignore")
    assert ids(scan_table(spark, "compact_modes")) == [0, 1, 2, 3, 4]
    assert runs.value == 0
    write_compact(scan_table(spark, "compact_modes").where("id > 2"), "compact_copy", path=str(tmp_path / "copy"))
    assert ids(scan_table(spark, "compact_copy")) == [3, 4]


def test_compact_write_leaves_no_scratch_files(spark, tmp_path):
    folder = Path(re.sub("^file:", "", ensure_checkpoint_dir(spark)))
    before = set(folder.iterdir())
    write_compact(numbers(spark, 0, 9), "compact_clean", path=str(tmp_path / "clean"))
    missing = spark.range(1).select(F.raise_error(F.lit("broken")).alias("id"))
    with pytest.raises(TableWriteError, match="broken"):
        write_compact(missing, "compact_broken", path=str(tmp_path / "broken"))
    assert set(folder.iterdir()) == before


def test_compact_writes_in_two_threads_keep_their_own_targets(spark, tmp_path):
    lineitem = table(spark, "/root/testdata/sf0.1", "lineitem").repartition(8)
    lineitem.cache().count()

    def write(target):
        name = f"compact_{target}"
        write_compact(lineitem, name, target_file_mb=target, path=str(tmp_path / name))
        return len(parquet_files(tmp_path / name))

    try:
        alone = [write(target) for target in (1, 64)]
        with ThreadPoolExecutor(2) as pool:
            assert list(pool.map(write, (1, 64))) == alone
    finally:
        lineitem.unpersist()
    assert alone[0] > alone[1] == 1
