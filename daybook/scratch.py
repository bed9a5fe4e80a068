"""The folder, shared by driver and executors, for checkpoints and scratch tables."""

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession

# Paths and tables made here, by application.
_made: dict[str, list[tuple[str, str | None]]] = {}

_SAME_MACHINE = re.compile(r"local(\[.*\]|-cluster\[.*\])?")


def _is_temporary(folder: str) -> bool:
    """A folder of this machine's temporary files, which executors elsewhere can't see."""
    path = re.sub(r"^file:/*", "/", folder)
    return any(
        path == top or path.startswith(f"{top}/") for top in ("/tmp", "/var/tmp", tempfile.gettempdir())
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder where the context checkpoints: the one already set, or spark.checkpoint.dir.

    A machine-local folder stands in only when Spark itself runs on this machine, and
    a temporary one is refused otherwise.
    """
    context = spark.sparkContext
    here = _SAME_MACHINE.fullmatch(context.master)
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not here:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="daybook-"))
    folder = context.getCheckpointDir()
    if not here and _is_temporary(folder):
        raise RuntimeError(f"spark.checkpoint.dir is local to one machine: {folder}")
    return folder


def _place(spark: SparkSession, prefix: str, is_table: bool) -> tuple[str, str]:
    name = f"{prefix}_{uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark)}/{name}"
    made = _made.setdefault(spark.sparkContext.applicationId, [])
    made.append((path, name if is_table else None))
    return name, path


def new_path(spark: SparkSession, prefix: str = "daybook") -> str:
    """A path for scratch files, not made yet."""
    return _place(spark, prefix, is_table=False)[1]


def new_table(spark: SparkSession) -> dict[str, str]:
    """Name and path for a scratch table."""
    name, path = _place(spark, "daybook", is_table=True)
    return {"name": name, "path": path}


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """A path for scratch files that goes, with all below it, at the end of the block."""
    path = new_path(spark)
    try:
        yield path
    finally:
        _delete(spark, path)
        _made[spark.sparkContext.applicationId].remove((path, None))


def clean_scratch(spark: SparkSession) -> int:
    """Drop all scratch tables and files made so far, and say how many there were.

    Frames that were returned but not read yet may still need theirs: call this only once
    all results are stored elsewhere. Checkpoints go with the frames they belong to,
    where spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    made = _made.pop(spark.sparkContext.applicationId, [])
    for path, name in made:
        if name is not None:
            spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        _delete(spark, path)
    return len(made)
