"""From stored evidence to a published result: conservation, input fingerprint, rebuild, and the request for it."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import canonical, completeness
from ..operators.publication import fingerprint, stabilize_conflicts
from ..operators.reconcile import Inputs, Result, reconcile
from ..schemas import ENTITIES, REPORTS, record_type
from ..sources.deliveries import gate, judged
from ..sources.ledger import Ledger
from .checkpoints import saved
from .recovery import Queue, Request
from .store import Store

_RECEIPT = (
    "delivery_key", "receipt_id", "source_system", "entity_type", "source_id", "source_version", "payload_hash",
    "received_at_utc"
)
_EMPTY = (
    "delivery_key string, receipt_id string, source_system string, entity_type string, source_id string, "
    "source_version long, payload_hash string, received_at_utc timestamp"
)


class EvidenceLost(ValueError):
    """Stored receipts do not add up to what was ingested."""


def envelopes(ledger: Ledger, as_of) -> DataFrame:
    """Every receipt fit for use that had come in by ``as_of``, of all entities, without its record."""
    out = ledger.spark.createDataFrame([], _EMPTY)
    for e in ENTITIES:
        r = ledger.receipts(e)
        if r is not None:
            out = out.unionByName(r.select(*_RECEIPT))
    return out.where(F.col("received_at_utc") <= F.lit(as_of).cast("timestamp"))


def lost_evidence(ledger: Ledger, as_of) -> DataFrame:
    """(delivery_key, problem) of each batch whose stored rows do not add up, or do not belong to its report."""
    b = ledger.batches().where(F.col("received_at_utc") <= F.lit(as_of).cast("timestamp"))
    entity = F.create_map(*[F.lit(x) for r, (e, _, _) in REPORTS.items() for x in (r, e)])[F.col("report_type")]
    b = b.select("delivery_key", F.lower("source_system").alias("system"), entity.alias("entity"), "observed_row_count")
    q = ledger.quarantine().select("delivery_key", F.lit(None).cast("string").alias("source_system"), "entity_type")
    rows = envelopes(ledger, as_of).select("delivery_key", "source_system", "entity_type").unionByName(q)
    n = rows.groupBy("delivery_key", "source_system", "entity_type").agg(F.count(F.lit(1)).alias("n"))
    both = b.join(n, "delivery_key", "left")
    foreign = (F.col("entity_type") != F.col("entity")) | (F.col("source_system") != F.col("system"))
    by = both.groupBy("delivery_key", "observed_row_count").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.bool_or(foreign).alias("foreign")
    )
    problem = F.when(
        F.col("n") != F.col("observed_row_count"), "ROWS_NOT_CONSERVED"
    ).when(F.col("foreign"), "IDENTITY_MISMATCH")
    return by.select("delivery_key", problem.alias("problem")).where("problem IS NOT NULL")


def input_fingerprint(ledger: Ledger, as_of) -> str:
    """A digest of what a rebuild as of an instant reads: batches, declared days, receipts and quarantined rows.

    Dispositions and completeness follow from these; equal inputs in any order have equal digests.
    """
    stable = [c for c in _RECEIPT if c != "received_at_utc"]
    q = ledger.quarantine().where(
        F.col("received_at_utc") <= F.lit(as_of).cast("timestamp")
    ).select("delivery_key", "receipt_id", "reason_code")
    b = ledger.batches().where(F.col("received_at_utc") <= F.lit(as_of).cast("timestamp")).select(
        "delivery_key", "batch_id", "status", "error_message", "file_checksum", "manifest_checksum", "report_type",
        "report_date", "declared_row_count", "observed_row_count"
    )
    frames = [envelopes(ledger, as_of).select(*stable), q, b, ledger.declared_days()]
    parts = [fingerprint(df).first()[0] for df in frames]
    return ledger.spark.range(1).select(F.sha2(F.lit("|".join(parts)), 256)).first()[0]


def rebuild(
    ledger: Ledger, run_id: str, as_of, *, expected_days: DataFrame | None = None, judge_reports: bool = True
) -> Result:
    """Reconcile all evidence that had come in by ``as_of``.

    Raises ``EvidenceLost`` unless every ingested row is a receipt or quarantined.
    Reports are judged from the stored bytes, over the days that the ledger expects
    and ``expected_days``, and the worst state of each report gates the rules;
    without ``judge_reports`` the rules run ungated.
    """
    bad = lost_evidence(ledger, as_of).take(5)
    if bad:
        raise EvidenceLost(f"stored evidence does not add up: {[tuple(b) for b in bad]}")
    # One pass over an entity's receipts gives its current records and the receipts that are in conflict.
    clash = F.when(F.col("disposition") == "CONFLICTED", F.struct("receipt_id", *canonical.IDENTITY, "source_version", "payload_hash"))
    found = {
        e: saved(ev.where("disposition IN ('ACCEPTED', 'CONFLICTED')").select(
            F.when(F.col("disposition") == "ACCEPTED", F.col("record")).alias("record"), clash.alias("clash")
        )) for e, ev in ledger.evidence(as_of).items()
    }
    none = lambda e: ledger.spark.createDataFrame([], record_type(e))
    frames = [
        found[e].where("record IS NOT NULL").select("record.*") if e in found else none(e) for e in (
            "ORDER", "PAYMENT", "REFUND", "FEE", "SETTLEMENT_LINE", "PAYOUT"
        )
    ]
    receipts = ledger.spark.createDataFrame([], _EMPTY).drop("delivery_key", "received_at_utc")
    for df in found.values():
        receipts = receipts.unionByName(df.where("clash IS NOT NULL").select("clash.*"))
    receipts = saved(receipts)
    done = None
    if judge_reports:
        due = ledger.expected_days()
        due = due if expected_days is None else due.unionByName(expected_days.select("business_date"))
        days = completeness.stored_completeness(ledger.stored_batches(), due, F.lit(as_of).cast("timestamp"))
        done = saved(completeness.worst_by_report(days))
    q = ledger.quarantine().where(F.col("received_at_utc") <= F.lit(as_of).cast("timestamp"))
    q = q.select("entity_type", "source_id", "reason_code", "reason_detail", "raw_payload_json")
    out = reconcile(
        Inputs(*frames, done, canonical.conflicts(receipts), q), run_id, as_of, check=done is not None
    )
    # Receipt ids name deliveries; what supports a conflict is named by what the receipts brought, which outlasts them.
    return replace(
        out, exceptions=stabilize_conflicts(out.exceptions, receipts), input_fingerprint=input_fingerprint(ledger, as_of)
    )


def ingest(
    ledger: Ledger, queue: Queue, deliveries: DataFrame, received_at: datetime
) -> tuple[DataFrame, list[Request]]:
    """Store deliveries and ask for one rebuild of each committed one; returns findings of all and the new requests.

    Requests are made for every committed batch that has none, so a crash after
    the ledger's commit is made good by the next call; only the keys of those come
    to the driver.  The days of stored reports, failed ones included, count as
    expected from then on (``Ledger.expected_days``).
    """
    spark = ledger.spark
    found = saved(judged(gate(deliveries)))
    ledger.ingest(found, received_at)
    known = spark.createDataFrame([(r.request_id,) for r in queue.requests()], "request_id string")
    batches = ledger.batches().where("status = 'COMMITTED'").select(
        "delivery_key", "batch_id", F.substring(F.sha2("delivery_key", 256), 1, 32).alias("request_id")
    )
    made = [
        queue.enqueue(row["delivery_key"], "EVIDENCE_COMMITTED", received_at, trigger_batch_id=row["batch_id"])
        for row in batches.join(known, "request_id", "left_anti").orderBy("request_id").toLocalIterator()
    ]
    return found.select("stem", "state", F.coalesce("fault", "reason").alias("reason")), made


def inspections(queue: Queue, ledger: Ledger, store: Store) -> DataFrame:
    """(request_id, status, attempt_count, batch_status, run_published, action, problem) of every request.

    ``action`` is what an operator should do; where a request contradicts the ledger
    or the store it is null and ``problem`` says how.  The rows of the current run are
    read again and held against its fingerprint, so that nobody is told not to repeat
    a run whose rows are damaged.  The queue is small and comes from the driver;
    batches and runs are joined to it.
    """
    spark, fields = ledger.spark, (
        "request_id", "status", "attempt_count", "max_attempts", "next_attempt_at_utc", "completed_at_utc",
        "last_error", "result_run_id", "trigger_batch_id"
    )
    schema = "request_id string, status string, attempt_count int, max_attempts int, next_attempt_at_utc string, "
    schema += "completed_at_utc string, last_error string, result_run_id string, trigger_batch_id string"
    q = spark.createDataFrame([tuple(getattr(r, f) for f in fields) for r in queue.requests()], schema)
    b = ledger.batches().select(F.col("batch_id").alias("trigger_batch_id"), F.col("status").alias("batch_status"))
    damaged = {store.current()["run_id"]} if store.current() and not store.sound() else set()
    runs = spark.createDataFrame(
        [(r, True, r in damaged) for r in store.runs()], "result_run_id string, run_published boolean, damaged boolean"
    )
    df = q.join(b, "trigger_batch_id", "left").join(runs, "result_run_id", "left").withColumn(
        "run_published", F.coalesce("run_published", F.lit(False))
    )
    c, now = F.col, F.lit(queue.clock()).cast("timestamp")
    open_ = c("result_run_id").isNotNull() | c("completed_at_utc").isNotNull()
    problem = (
        F.when(~c("batch_status").eqNullSafe(F.lit("COMMITTED")), "NOT_ON_COMMITTED_EVIDENCE")
        .when((c("status") == "SUCCEEDED") & (c("completed_at_utc").isNull() | ~c("run_published")), "RESULT_MISSING")
        .when((c("status") == "SUCCEEDED") & c("damaged"), "RESULT_DAMAGED")
        .when(
            (c("status") == "FAILED") & (
                c("result_run_id").isNotNull() | c("completed_at_utc").isNull() | c("last_error").isNull()
            ),
            "FAILED_INCONSISTENT"
        )
        .when(
            (c("status") == "PENDING") & (open_ | (c("attempt_count") >= c("max_attempts"))), "PENDING_INCONSISTENT"
        )
        .when(~c("status").isin("SUCCEEDED", "FAILED", "PENDING"), "UNKNOWN_STATUS")
    )
    action = (
        F.when(c("status") == "SUCCEEDED", "DO_NOT_REPEAT")
        .when(c("status") == "FAILED", "MANUAL_REQUEUE")
        .when(c("next_attempt_at_utc").cast("timestamp") <= now, "RETRY_NOW")
        .otherwise("WAIT_FOR_RETRY")
    )
    return df.withColumn("problem", problem).select(
        "request_id", "status", "attempt_count", "batch_status", "run_published",
        F.when(c("problem").isNull(), action).alias("action"), "problem"
    )
