"""Session defaults for tests and the bench, and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A small session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("panelspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def has_checkpoint_dir(spark: SparkSession) -> bool:
    """True when the cluster names a shared checkpoint folder."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return True
    return spark.sparkContext.getCheckpointDir() is not None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody else uses in the folder that the cluster shares; on one machine alone,
    a temporary folder may stand in for it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        folder = "file://" + tempfile.mkdtemp(prefix="panelspark-")
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """``df`` kept for the session: for tables that many later, lazy passes read."""
    if has_checkpoint_dir(df.sparkSession):
        return _checkpointed(df)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def _checkpointed(df: DataFrame) -> DataFrame:
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir"))
    return df.checkpoint(eager=True)


@contextmanager
def reused(df: DataFrame):
    """Yield ``df`` in a form that many passes can read without recomputing it.

    With a shared checkpoint folder the rows are written there, so a lost
    executor costs a re-read and not a recomputation of the joins upstream.
    Without one they are persisted (memory, then disk) and recomputed if lost.
    """
    if has_checkpoint_dir(df.sparkSession):
        yield _checkpointed(df)
        return
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
