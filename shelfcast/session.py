"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session it gives you."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfcast")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


_TEST_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Where that setting is missing, as in tests, a local session gets one temporary folder; any
    other session must name it, as a machine-local path would be lost together with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _TEST_FOLDERS.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="shelfcast-"))


def table_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for an intermediate table."""
    return f"{shared_folder(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint in the shared folder.

    The blocks live in shared storage, so a lost executor costs no recomputation
    of what came before.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(os.path.join(shared_folder(spark), "checkpoints"))
    return df.checkpoint(eager=True)
