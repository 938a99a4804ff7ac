"""Frames written to the shared checkpoint folder, which cuts their lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Where it is unset a local folder is made, but only for a local master: on a
    cluster every executor would write into its own disk, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="settleforge-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Have a folder deleted when the driver's JVM ends; it must exist."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def saved(df: DataFrame, *by: str) -> DataFrame:
    """The frame, written once and read from there on; in a folder for each value of ``by``, columns that come last then."""
    path = f"{shared_dir(df.sparkSession)}/frames/{uuid.uuid4().hex}"
    out = df.write.partitionBy(*by) if by else df.write
    out.parquet(path)
    delete_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
