"""Scratch tables in the folder that the cluster shares.

A table is written once as Parquet, which cuts the lineage: executors lost later
cost a re-read and never a recomputation.  Tables that no later plan reads are
dropped at once, the others when the driver's JVM ends.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..plans.checkpoints import delete_at_end, shared_dir

#: Rows that go to Python at a time; texts are long, and a batch is held by the JVM and by the worker at once.
BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Scratch tables of one call; ``drop`` deletes one that no later plan reads."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.paths = spark, f"{shared_dir(spark)}/settleforge/{uuid.uuid4().hex}", {}
        self.made = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{name}-{self.made}"
        df.write.parquet(path)
        if self.made == 1:
            delete_at_end(self.spark, self.root)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def tidy(self) -> None:
        """Have Spark free broadcast tables and shuffle files of finished steps.

        It frees what the driver's garbage collector finds unreachable, and the
        driver of a long iteration collects too seldom for its executors.
        """
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, df: DataFrame) -> None:
        remove(self.spark, self.paths.pop(id(df))[0])
