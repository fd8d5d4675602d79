"""Shared scratch locations for written intermediate tables.

Intermediate tables go under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), never under a machine-local temporary folder:
every executor must see them, and they must outlive a lost executor.  Only
when the session names no folder (a bare local test session) do we set one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_leaving: set[str] = set()


def checkpoint_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder.

    A local session without one (tests) gets a temporary folder.  On a
    cluster a missing folder is an error: executors write to their own disks,
    and reading back would miss what the others wrote.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-checkpoints-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path below the shared checkpoint folder.  The
    application's folder is removed when the driver ends."""
    top = f"{checkpoint_root(spark)}/tidemark/{spark.sparkContext.applicationId}"
    if top not in _leaving:
        path = spark._jvm.org.apache.hadoop.fs.Path(top)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
        _leaving.add(top)
    return f"{top}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back.

    Cuts the lineage: what follows reads files that outlive a lost executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete a table of :func:`materialise` that nothing will read again.
    Tables elsewhere are left alone."""
    spark = df.sparkSession
    top = f"/tidemark/{spark.sparkContext.applicationId}/"
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if top in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
