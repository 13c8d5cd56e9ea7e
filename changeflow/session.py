"""Session helpers: shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a private one only in local mode."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="changeflow-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder's name in the shared folder; ``drop_scratch`` removes what was written there."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    context = spark.sparkContext
    if not hasattr(context, "_changeflow_scratch"):
        context._changeflow_scratch = []
    context._changeflow_scratch.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Remove all scratch folders this application has named so far; frames that read from them end with it."""
    context = spark.sparkContext
    paths, removed = getattr(context, "_changeflow_scratch", []), 0
    for name in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        removed += path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    paths.clear()
    return removed


def pin(df: DataFrame) -> DataFrame:
    """Fix a frame's rows and partition layout on reliable storage."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder (or at ``path``) and read it back."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
