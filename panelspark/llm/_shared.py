"""Tables and files in the folder that driver and executors share; what Python workers keep."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_MADE: list = []
#: How to drop what the tasks of an operator keep in this Python worker for the next ones.
_KEPT: list[Callable[[], None]] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of its own where none is named (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="panelspark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody else uses, deleted when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.append((spark, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and still there
    when the executors that computed it are lost."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


@atexit.register
def release() -> None:
    """Delete what ``new_folder`` has named in this driver."""
    while _MADE:
        spark, path = _MADE.pop()
        try:
            jvm = spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # noqa: BLE001 — the session may have ended before the driver
            return


def keep(drop: Callable[[], None]) -> Callable[[], None]:
    """Name how to drop what this worker keeps between tasks."""
    _KEPT.append(drop)
    return drop


def drop_kept() -> None:
    """Drop what the tasks of other operators have left in this worker: Spark uses a worker
    again for any task, and what all of them keep would add up."""
    for drop in _KEPT:
        drop()


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it new to ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
