"""Keyed state of the evidence: what a batch of receipts has to know, and no more.

Three tables lie in buckets.  ``state`` has a row for each entity, by a hash of its
identity: the highest version and the payloads that it came with.  ``ids`` has a row
for each receipt, by the same hash, which finds exact replays and ids that an entity
uses twice.  ``keys`` has the receipt ids alone with the bucket of their entity, by a
hash of the id, which finds ids that two entities use.  A batch is written in buckets
once; from there on each bucket is one task, which reads what is known of the bucket
beside the batch's rows, so nothing that is known is shuffled.  A batch reads and
rewrites the state of the buckets that its entities fall into, reads their ids and the
keys of the buckets that its new receipts fall into, and appends to both; other buckets
are not read.  With more buckets a small batch touches less and a large one has smaller
tasks.

A manifest names the files of each bucket and the last batch.  It is replaced in one
step at the end, so a batch that breaks off changes nothing, and one that Spark runs
again is known by its number: it returns what it returned before.  One writer at a
time, as a streaming query has it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.canonical import IDENTITY, EvidenceError
from ..operators.late import NEW, kinds_by_top
from ..plans.store import FileSystem

#: Folders of a bucket of ids or keys above which they are put together.
MAX_FILES = 8
_WHO = [T.StructField(c, T.StringType()) for c in IDENTITY]
_VERSION, _HASH = T.StructField("source_version", T.LongType()), T.StructField("payload_hash", T.StringType())
_FIRST, _RECEIPT = T.StructField("first", T.StringType()), T.StructField("receipt_id", T.StringType())
_STATE = T.StructType(
    [*_WHO, _VERSION, T.StructField("payloads", T.ArrayType(T.StructType([_HASH, _FIRST, _RECEIPT])))]
)
_IDS = T.StructType([_RECEIPT, *_WHO, _VERSION, _HASH])
_CHANGES = T.StructType([*_IDS.fields, T.StructField("change_kind", T.StringType())])
_JUDGED = T.StructType([*_CHANGES.fields, _FIRST, T.StructField("split", T.BooleanType())])
_KEYS = T.StructType([_RECEIPT, T.StructField("owner", T.IntegerType())])


class EvidenceState:
    """State under ``root``; ``first_seen`` names a column whose smallest value picks the representative receipt."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, first_seen: str | None = None):
        self.spark, self.files, self.first_seen = spark, FileSystem(spark, root), first_seen
        text = self.files.read("manifest.json")
        self.manifest = json.loads(text) if text else {
            "batch": -1, "buckets": buckets, "state": {}, "ids": {}, "keys": {}, "changes": None
        }
        if "keys" not in self.manifest:
            raise ValueError(f"the state under {root} has an older layout; it must be made again from its receipts")
        self.buckets = self.manifest["buckets"]

    def _bucket(self, *keys: str) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def _read(self, paths: list[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.files.root}/{p}" for p in paths])

    def _folders(self, folder: str) -> dict[str, str]:
        return {n.removeprefix("_b="): f"{folder}/{n}" for n in self.files.folders(folder)}

    def _write(self, df: DataFrame | None, folder: str) -> dict[str, str]:
        """Rows with a column ``_b``, one folder a bucket; returns where each lies."""
        if df is None:
            return {}
        # Hashes and ids are most of what is written; this codec halves them.
        df.write.option("compression", "zstd").partitionBy("_b").parquet(f"{self.files.root}/{folder}")
        return self._folders(folder)

    def _one(self, paths: list[str], schema: T.StructType) -> DataFrame:
        """Rows of one bucket, in one task: what is grouped or joined in there needs no shuffle."""
        return self._read(paths, schema).coalesce(1)

    def _each(self, buckets: Iterable[str], make: Callable[[str], DataFrame]) -> DataFrame | None:
        """What ``make`` gives for each bucket, which is its column ``_b``; a task a bucket, None without one."""
        made = [make(b).withColumn("_b", F.lit(int(b))) for b in sorted(buckets, key=int)]
        if not made:
            return None
        # Spark unites frames that all have one partition in one task; a frame without partitions keeps it from that.
        apart = self.spark.createDataFrame(self.spark.sparkContext.emptyRDD(), made[0].schema)
        return reduce(DataFrame.union, [apart, *made])

    def _appended(self, table: str, paths: dict[str, str], schema: T.StructType) -> dict[str, list[str]]:
        """A table's folders by bucket with new ones added; those of a bucket that has too many are put together."""
        after = {k: list(v) for k, v in self.manifest[table].items()}
        for b, path in paths.items():
            after.setdefault(b, []).append(path)
        full = {b: p for b, p in after.items() if len(p) > MAX_FILES}
        one = self._write(self._each(full, lambda b: self._one(full[b], schema)), f"{table}/{uuid.uuid4().hex}")
        return after | {b: [p] for b, p in one.items()}

    def apply(self, batch: DataFrame, batch_id: int | None = None) -> DataFrame:
        """Take up receipts; returns the new ones with what each changes (``late.change_kinds``).

        An exact replay adds nothing.  Raises, and changes nothing, where a receipt id
        comes with other contents than before.  ``batch`` is read once.  ``batch_id``: numbers that rise; one
        that is not above the last is known already.
        """
        batch_id = self.manifest["batch"] + 1 if batch_id is None else batch_id
        if batch_id <= self.manifest["batch"]:
            if batch_id == self.manifest["batch"]:
                return self._changes()
            raise ValueError(f"batch {batch_id} was taken up long ago")
        seen = F.lit("") if self.first_seen is None else F.date_format(self.first_seen, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        folder, m = f"batches/{uuid.uuid4().hex}", self.manifest
        schema = T.StructType([*_IDS.fields, _FIRST])
        rows = batch.select(*[F.col(f.name).cast(f.dataType) for f in _IDS], seen.alias("first"))
        # The only time that the batch's rows are dealt out, and as files.
        came = self._write(rows.withColumn("_b", self._bucket(*IDENTITY)), folder)

        def judged(b: str) -> DataFrame:
            """New receipts of a bucket with what each changes, and ids that come with two contents (``split``)."""
            both = self._one([came[b]], schema).withColumn("old", F.lit(False))
            if b in m["ids"]:
                known = self._one(m["ids"][b], _IDS).withColumn("old", F.lit(True))
                both = both.unionByName(known, allowMissingColumns=True).coalesce(1)
            content = F.struct(*_IDS.names[1:])
            new = both.groupBy("receipt_id").agg(
                F.min(content).alias("lo"), F.max(content).alias("hi"), F.min("first").alias("first"), F.max("old").alias("old")
            ).where("lo <> hi OR NOT old").select("receipt_id", "lo.*", "first", F.expr("lo <> hi").alias("split"))
            if b not in m["state"]:
                return new.withColumn("change_kind", F.lit(NEW)).select(*_JUDGED.names)
            top = self._one([m["state"][b]], _STATE).select(
                *IDENTITY, F.col("source_version").alias("_top"), F.col("payloads.payload_hash").alias("_hashes")
            )
            return kinds_by_top(new, top.hint("merge")).select(*_JUDGED.names)

        changes = f"{folder}-changes"
        new = self._write(self._each(came, judged), changes)
        found = self._read(list(new.values()), _JUDGED)
        self._refuse(found.where("split").select("receipt_id"))

        # Ids that two entities of one bucket use have been found; those of several buckets are found by the ids alone.
        owners = self._each(new, lambda b: self._read([new[b]], _IDS).select("receipt_id", F.lit(int(b)).alias("owner")))
        keys = self._write(owners and owners.withColumn("_b", self._bucket("receipt_id")), f"keys/{uuid.uuid4().hex}")
        twice = self._each(
            keys, lambda b: self._one([keys[b], *m["keys"].get(b, [])], _KEYS).groupBy("receipt_id").agg(
                F.min("owner").alias("lo"), F.max("owner").alias("hi")
            ).where("lo <> hi").select("receipt_id")
        )
        if twice is not None:
            self._refuse(twice.select("receipt_id"))

        def heads(b: str) -> DataFrame:
            """All entities of a bucket: those without a new receipt come out as they were."""
            rows = self._one([new[b]], _JUDGED).select(*IDENTITY, "source_version", "payload_hash", "first", "receipt_id")
            if b in m["state"]:
                held = self._one([m["state"][b]], _STATE).select(
                    *IDENTITY, "source_version", F.explode_outer("payloads").alias("p")
                ).select(*IDENTITY, "source_version", "p.*")
                rows = rows.unionByName(held).coalesce(1)
            # The earliest receipt of each payload, then all payloads of the highest version.
            rows = rows.groupBy(*IDENTITY, "source_version", "payload_hash").agg(
                F.min(F.struct("first", "receipt_id")).alias("m")
            )
            one = F.when(F.col("m.receipt_id").isNotNull(), F.struct("payload_hash", "m.first", "m.receipt_id"))
            rows = rows.groupBy(*IDENTITY, "source_version").agg(F.sort_array(F.collect_list(one)).alias("payloads"))
            return rows.groupBy(*IDENTITY).agg(
                F.max_by("payloads", "source_version").alias("payloads"), F.max("source_version").alias("source_version")
            ).select(*_STATE.names)

        made = self._write(self._each(new, heads), f"state/{uuid.uuid4().hex}")
        manifest = m | {
            "batch": batch_id, "state": m["state"] | made, "ids": self._appended("ids", new, _IDS),
            "keys": self._appended("keys", keys, _KEYS), "changes": changes
        }
        self.files.write("manifest.json", json.dumps(manifest, sort_keys=True))
        self.manifest = manifest
        self.files.delete(folder)
        return self._changes()

    def _changes(self) -> DataFrame:
        """What the last batch changed."""
        return self._read(list(self._folders(self.manifest["changes"]).values()), _CHANGES)

    def _refuse(self, reused: DataFrame) -> None:
        bad = reused.take(5)
        if bad:
            raise EvidenceError(f"receipt ids reused with different contents: {[r[0] for r in bad]}")

    def state(self) -> DataFrame:
        """One row for each entity: its highest version and the payloads that it came with."""
        return self._read(list(self.manifest["state"].values()), _STATE)

    def receipts(self) -> DataFrame:
        return self._read([p for paths in self.manifest["ids"].values() for p in paths], _IDS)

    def dispositions(self) -> DataFrame:
        """What became of every receipt, as ``canonical.evidence`` says it of all of them at once; the plan has no exchange."""
        m = self.manifest

        def bucket(b: str) -> DataFrame:
            s = self._one([m["state"][b]], _STATE).select(
                *IDENTITY, F.col("source_version").alias("_top"), F.size("payloads").alias("_n"),
                F.get("payloads", F.lit(0))["receipt_id"].alias("_first")
            )
            df = self._one(m["ids"][b], _IDS).join(s.hint("merge"), list(IDENTITY))
            # Where a version has one payload, its earliest receipt is the accepted one.
            kind = (
                F.when(F.col("source_version") < F.col("_top"), "STALE").when(F.col("_n") > 1, "CONFLICTED")
                .when(F.col("_first") == F.col("receipt_id"), "ACCEPTED").otherwise("DUPLICATE")
            )
            return df.withColumn("disposition", kind).drop("_top", "_n", "_first")

        out = self._each(m["ids"], bucket)
        none = T.StructType([*_IDS.fields, T.StructField("disposition", T.StringType())])
        return self.spark.createDataFrame([], none) if out is None else out.drop("_b")

    def vacuum(self) -> int:
        """Delete folders that the manifest does not name; returns how many.  Nobody may be reading an older state."""
        m = self.manifest
        used = [*m["state"].values(), m["changes"] or ""]
        used += [p for table in ("ids", "keys") for paths in m[table].values() for p in paths]
        keep = {tuple(p.split("/")[:2]) for p in used}
        gone = [
            f"{top}/{name}" for top in ("state", "ids", "keys", "batches") for name in self.files.folders(top)
            if (top, name) not in keep
        ]
        for name in gone:
            self.files.delete(name)
        return len(gone)
