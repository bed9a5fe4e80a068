"""Where checkpoints and scratch tables may go."""

from types import SimpleNamespace

import pytest

from pyspark.errors import AnalysisException

from daybook.scratch import clean_scratch, ensure_checkpoint_dir, new_path, new_table
from daybook.sinks import write_table


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(context, named=None):
    conf = SimpleNamespace(get=lambda key, default: named or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_named_folder_is_used():
    context = Context("yarn")
    assert ensure_checkpoint_dir(session(context, "hdfs:///shared")) == "hdfs:///shared"
    assert context.folder == "hdfs:///shared"


def test_a_folder_already_set_stays():
    assert ensure_checkpoint_dir(session(Context("yarn", "hdfs:///set"))) == "hdfs:///set"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session(Context("spark://host:7077")))


def test_a_local_session_gets_a_temporary_folder(tmp_path, monkeypatch):
    monkeypatch.setattr("tempfile.mkdtemp", lambda prefix: str(tmp_path))
    assert ensure_checkpoint_dir(session(Context("local[2]"))) == str(tmp_path)


def test_the_folder_that_the_context_uses_wins():
    context = Context("yarn", "hdfs:///set")
    assert ensure_checkpoint_dir(session(context, "hdfs:///other")) == "hdfs:///set"


@pytest.mark.parametrize("folder", ["file:/tmp/x", "file:///var/tmp/x", "/tmp", "/tmp/daybook"])
def test_temporary_folders_of_one_machine_are_refused_on_a_cluster(folder):
    with pytest.raises(RuntimeError, match="local to one machine"):
        ensure_checkpoint_dir(session(Context("spark://host:7077"), folder))
    for master in ("local[4]", "local", "local-cluster[3,2,1024]"):
        assert ensure_checkpoint_dir(session(Context(master), folder)) == folder


@pytest.mark.parametrize("folder", ["hdfs:///tmp/x", "s3a://store/x", "file:/mnt/shared/x"])
def test_shared_folders_are_taken_on_a_cluster(folder):
    assert ensure_checkpoint_dir(session(Context("yarn"), folder)) == folder


def test_the_test_session_names_one(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark).removeprefix("file:").startswith(named)


def test_scratch_is_dropped_when_asked(spark):
    clean_scratch(spark)
    table, files = new_table(spark), new_path(spark)
    write_table(spark.range(3), **table)
    spark.range(3).write.parquet(files)
    assert spark.table(table["name"]).count() == spark.read.parquet(files).count() == 3
    assert clean_scratch(spark) == 2
    assert not spark.catalog.tableExists(table["name"])
    for path in (table["path"], files):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            spark.read.parquet(path)
    assert clean_scratch(spark) == 0
