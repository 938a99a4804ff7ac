"""The ingestion ledger: append-only Parquet tables of batches, receipts and typed records.

A delivery is appended once, by its key; dispositions are derived from the
receipts when they are read and never updated.  Every append carries the id of its
attempt, and only rows of an attempt that has a batch row are read, so what a
broken attempt left behind needs no removal and reading needs no shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.identity import receipt_id
from ..operators.canonical import IDENTITY, evidence, unique_receipts
from ..plans.checkpoints import saved
from ..plans.store import FileSystem
from ..schemas import ENTITIES, REPORTS
from .validate import judged, split

#: Faults of deliveries whose rows can be read; the ledger keeps those as FAILED batches.
KEPT_FAULTS = ("CHECKSUM_MISMATCH", "ROW_COUNT_MISMATCH")
_BATCH = (
    "delivery_key string, batch_id string, attempt string, source_system string, report_type string, report_date date, "
    "original_filename string, schema_version string, file_checksum string, manifest_checksum string, "
    "declared_row_count long, observed_row_count long, received_at_utc timestamp, data_bytes binary, "
    "manifest_bytes binary, status string, error_message string"
)
_QUARANTINE = (
    "delivery_key string, batch_id string, attempt string, received_at_utc timestamp, row_number int, "
    "receipt_id string, entity_type string, source_id string, reason_code string, reason_detail string, "
    "raw_payload_json string"
)


class RowsLost(ValueError):
    """What was written does not add up to what came in."""


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, FileSystem(spark, root)

    def _read(self, name: str) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.files.root}/{name}") if self.files.exists(name) else None

    def batches(self) -> DataFrame:
        """One row a delivery, COMMITTED or FAILED; of two writers of one delivery the first counts."""
        df = self._read("batches")
        if df is None:
            return self.spark.createDataFrame([], _BATCH)
        first = Window.partitionBy("delivery_key").orderBy("received_at_utc", "attempt")
        return df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")

    def _stored(self, name: str) -> DataFrame | None:
        """Rows that an attempt with a batch row has stored; None where there is no batch row at all."""
        df = self._read(name) if self.files.exists("batches") else None
        keys = ["delivery_key", "attempt"]
        return None if df is None else df.join(self.batches().select(*keys), keys, "left_semi")

    def receipts(self, entity: str) -> DataFrame | None:
        """Valid receipts of one entity: receipt columns and the typed record."""
        return self._stored(f"receipts/{entity}")

    def quarantine(self) -> DataFrame:
        """Rows that broke a rule, and all others of failed batches."""
        df = self._stored("quarantine")
        return self.spark.createDataFrame([], _QUARANTINE) if df is None else df

    def expect(self, days: DataFrame) -> None:
        """Declare business days (``business_date``) whose reports are due; a day declared again changes nothing."""
        days.select(F.col("business_date").cast("date")).distinct().write.mode("append").parquet(
            f"{self.files.root}/expected_days"
        )

    def declared_days(self) -> DataFrame:
        df = self._read("expected_days")
        return self.spark.createDataFrame([], "business_date date") if df is None else df.distinct()

    def expected_days(self) -> DataFrame:
        """Days that were declared, and those of any batch, failed ones included."""
        days = self.batches().select(F.col("report_date").alias("business_date"))
        return days.unionByName(self.declared_days()).distinct()

    def ingest(self, found: DataFrame, received_at, hook: Callable[[str], None] = lambda point: None) -> int:
        """Append deliveries whose key is new; returns how many.

        ``found``: deliveries from ``verify``, or from ``judged``: of those with a
        fault, the ones whose rows can be read (``KEPT_FAULTS``) become FAILED
        batches, whose valid rows are quarantined with BATCH_VALIDATION_FAILED.

        Rows are counted while they are written, by delivery: unless every row of every
        delivery has become a receipt or been quarantined, ``RowsLost`` is raised and no
        batch row is written, so nothing of the attempt is ever read.

        A repeated delivery changes nothing.  After a crash between the appends the
        delivery has no batch row: nothing of it is read, and ingesting it again
        completes it.  ``hook`` is called between the appends.
        """
        attempt = uuid.uuid4().hex
        fault = F.col("fault") if "fault" in found.columns else F.lit(None).cast("string")
        new = found.withColumn("fault", fault).where("delivery_key IS NOT NULL").dropDuplicates(["delivery_key"])
        # Written, so that the many plans below do not each carry the plan that the deliveries came from.
        new = saved(new.join(self.batches().select("delivery_key"), "delivery_key", "left_anti").withColumns(
            {
                "received_at_utc": F.lit(received_at).cast("timestamp"), "attempt": F.lit(attempt),
                "batch_id": F.substring("delivery_key", 1, 32)
            }
        ), "report_type")
        n = new.count()
        if n:
            # By report, how many rows there are, and a sum that also tells of which deliveries.
            mark = F.pmod(F.xxhash64("delivery_key"), F.lit(1 << 31))
            due = new.groupBy("report_type").agg(
                F.sum(F.size("rows")).alias("n"), F.sum(F.size("rows") * mark).alias("s"),
                F.bool_or(F.col("fault").isNotNull()).alias("faulty")
            ).collect()
            faulty = {r["report_type"]: r["faulty"] for r in due}
            due = {r["report_type"]: (r["n"], r["s"]) for r in due}
            for report, (entity, _, _) in REPORTS.items():
                if report not in due:
                    continue
                rows = new.where(F.col("report_type") == report).select(
                    "delivery_key", "batch_id", "attempt", "received_at_utc", F.col("fault").alias("_fault_of_batch"),
                    F.posexplode("rows").alias("row_number", "payload")
                )
                rows = rows.withColumn("receipt_id", receipt_id(F.col("delivery_key"), F.col("row_number")))
                rows = judged(rows.withColumn("_raw", F.col("payload")), entity)
                good, bad = split(rows, entity)
                failed = good.where("_fault_of_batch IS NOT NULL").select(
                    *bad.drop("_raw", "reason_code", "reason_detail", "raw_payload_json").columns,
                    F.lit("BATCH_VALIDATION_FAILED").alias("reason_code"),
                    F.concat(F.lit("the batch is bad: "), "_fault_of_batch").alias("reason_detail"),
                    F.to_json(F.try_parse_json("_raw")).alias("raw_payload_json")
                )
                kept = good.where("_fault_of_batch IS NULL").drop("_fault_of_batch", "_raw")
                lost = bad.drop("_raw")
                lost = (lost.unionByName(failed) if faulty[report] else lost).drop("_fault_of_batch")
                written = []
                for df, where in ((kept, f"receipts/{entity}"), (lost, "quarantine")):
                    # Rows are judged again for the quarantine only where some have not become receipts.
                    if written and written[0].get["n"] == due[report][0]:
                        continue
                    written.append(Observation())
                    df = df.observe(written[-1], F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(mark), F.lit(0)).alias("s"))
                    df.write.mode("append").parquet(f"{self.files.root}/{where}")
                got = tuple(sum(o.get[c] for o in written) for c in ("n", "s"))
                if got != due[report]:
                    raise RowsLost(f"{report}: {due[report][0]} rows came in, {got[0]} were stored")
                hook("after_rows")
            # The batch row comes last: a delivery without one has not been ingested.
            keep = new.select(
                "delivery_key", "batch_id", "attempt", "source_system", "report_type", "report_date",
                F.col("filename").alias("original_filename"), "schema_version",
                F.col("checksum_sha256").alias("file_checksum"), "manifest_checksum", "declared_row_count",
                F.size("rows").cast("long").alias("observed_row_count"), "received_at_utc", "data_bytes",
                "manifest_bytes", F.when(F.col("fault").isNull(), "COMMITTED").otherwise("FAILED").alias("status"),
                F.col("fault").alias("error_message")
            )
            keep.write.mode("append").parquet(f"{self.files.root}/batches")
        return n

    def current(self, as_of=None) -> dict[str, DataFrame]:
        """Current records by entity; with ``as_of`` only of what had been received by then."""
        return {e: ev.where("disposition = 'ACCEPTED'").select("record.*") for e, ev in self.evidence(as_of).items()}

    def evidence(self, as_of=None) -> dict[str, DataFrame]:
        """What became of each receipt, by entity, of all or of what had been received by ``as_of``; one shuffle an entity."""
        out = {}
        for e in ENTITIES:
            r = self.receipts(e)
            if r is not None:
                seen = r if as_of is None else r.where(F.col("received_at_utc") <= F.lit(as_of))
                # A receipt id is made of a delivery and a row, so it has one entity.
                seen = unique_receipts(seen.repartition(*IDENTITY), IDENTITY)
                # Of equal receipts the one that came first stays the representative, whatever comes later.
                out[e] = evidence(seen, "received_at_utc")
        return out

    def stored_batches(self) -> DataFrame:
        """Committed batches with receipt and quarantine counts, for certification from stored bytes."""
        none = self.spark.createDataFrame([], "delivery_key string, bad boolean")
        rows = none.unionByName(self.quarantine().select("delivery_key", F.lit(True).alias("bad")))
        for e in ENTITIES:
            r = self.receipts(e)
            if r is not None:
                rows = rows.unionByName(r.select("delivery_key", F.lit(False).alias("bad")))
        n = rows.groupBy("delivery_key").agg(
            F.count(F.lit(1)).alias("receipt_count"), F.count_if("bad").alias("quarantine_count")
        )
        b = self.batches().where("status = 'COMMITTED'").join(n, "delivery_key", "left")
        return b.fillna(0, ["receipt_count", "quarantine_count"])


def batch_dispositions(rows: DataFrame, declared: DataFrame) -> DataFrame:
    """Receipts of batches that may be bad: every row of a bad batch is quarantined, and keeps its evidence.

    ``rows``: batch_id, row_number, reason_code (null: valid); ``declared``:
    batch_id, declared_row_count, batch_error (null: sound).  A batch is also bad
    when the observed rows are not as many as declared.
    """
    n = rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("observed_row_count"))
    b = declared.join(n, "batch_id", "left").withColumn(
        "observed_row_count", F.coalesce("observed_row_count", F.lit(0))
    )
    bad = F.col("batch_error").isNotNull() | (F.col("observed_row_count") != F.col("declared_row_count"))
    b = b.select("batch_id", bad.alias("_bad"))
    df = rows.join(b, "batch_id")
    code = F.coalesce("reason_code", F.when(F.col("_bad"), "BATCH_VALIDATION_FAILED"))
    return df.select(
        "batch_id", "row_number", F.when(code.isNotNull(), "QUARANTINED").otherwise("PENDING").alias("disposition"),
        code.alias("reason_code"), F.when(F.col("_bad"), "FAILED").otherwise("PROCESSING").alias("batch_status")
    )
