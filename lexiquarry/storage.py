"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a session of local threads may go without, and takes a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.lexiquarry.shared", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='lexiquarry-')}"
        spark.conf.set("spark.lexiquarry.shared", root)
    return root.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: it is evaluated once, however often it is read."""
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
