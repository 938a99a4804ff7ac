"""Receipts in a table bucketed by identity: what became of each is settled without moving any.

A bucket holds all receipts of its entities, so the windows of ``canonical.evidence``
and the removal of repeated deliveries work on buckets as they are read; only what is
appended is shuffled, once.  The table lies at a path, and a session that does not
know it yet attaches it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.canonical import IDENTITY, evidence


class BucketedReceipts:
    """The table at ``path``; ``schema`` are its columns, of which ``canonical.evidence`` needs some.

    A bucket is one task, which sorts its receipts, so ``buckets`` should follow their
    number.  ``by``: columns of the identity that decide on the bucket; like
    ``buckets`` it stays what it was when the table was made.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, buckets: int = 64, by: tuple[str, ...] = IDENTITY
    ):
        self.spark, self.schema, self.buckets, self.by = spark, schema, buckets, by
        self.name = f"receipts_{hashlib.md5(path.encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        who, place = ", ".join(f"`{c}`" for c in by), path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet "
            f"OPTIONS (compression 'zstd') CLUSTERED BY ({who}) SORTED BY ({who}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )

    def append(self, receipts: DataFrame, placed: bool = False) -> None:
        """Add receipts: one file a bucket, dealt out as the table is.

        ``placed``: they lie by ``by`` in so many tasks already that each has whole
        buckets, and are not shuffled; where that is not so, buckets get more files.
        """
        rows = receipts.select(*[f"`{c}`" for c in self.schema.names])
        (rows if placed else rows.repartition(self.buckets, *self.by)).write.insertInto(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def unique(self) -> DataFrame:
        """One row a receipt id.  Receipts with one id are of one entity, so its bucket has them all."""
        return self.read().dropDuplicates([*IDENTITY, "receipt_id"])

    def evidence(self, first_seen: str | None = None) -> DataFrame:
        """What became of each receipt; the plan has no exchange."""
        return evidence(self.unique(), first_seen)

    def forget(self) -> None:
        """Drop the session's name for the table; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
