"""Canonicalization, completeness, late data, planning, publication, queue, deliveries, ledger, streams."""

import json
import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from settleforge.operators import canonical, completeness, impact, late, publication
from settleforge.plans import recovery
from settleforge.plans.store import FileSystem, MemoryStore, Store
from settleforge.sources import archive, deliveries
from settleforge.sources.ledger import Ledger
from settleforge.streaming import clickstream, receipts as receipt_stream
from test_scenarios import BASE, doc, order, payment, run_scenario

R = "receipt_id string, source_system string, entity_type string, source_id string, source_version long, payload_hash string"


def rows(*x):
    return [(r, "provider", "PAYMENT", i, v, h) for r, i, v, h in x]


def test_evidence_does_not_depend_on_order(spark):
    base = rows(("r1", "p", 1, "a"), ("r2", "p", 2, "b"), ("r3", "p", 2, "b"), ("r4", "q", 1, "a"), ("r5", "q", 1, "b"), ("r6", "q", 2, "c"), ("r7", "s", 3, "x"), ("r8", "s", 3, "y"), ("r9", "p", 1, "a"))
    want = {"r1": "STALE", "r2": "ACCEPTED", "r3": "DUPLICATE", "r4": "STALE", "r5": "STALE", "r6": "ACCEPTED", "r7": "CONFLICTED", "r8": "CONFLICTED", "r9": "STALE"}
    for seed in range(3):
        random.Random(seed).shuffle(base)
        df = spark.createDataFrame(base, R).repartition(1 + seed)
        assert {r["receipt_id"]: r["disposition"] for r in canonical.evidence(df).collect()} == want
    c = canonical.conflicts(df).collect()
    assert [(r["source_id"], r["payload_hashes"], r["receipt_ids"]) for r in c] == [("s", ["x", "y"], ["r7", "r8"])]


def test_replay_ledger(spark):
    ledger = canonical.ReplayLedger()
    a = spark.createDataFrame(rows(("r1", "p", 1, "a"), ("r2", "q", 1, "b")), R)
    b = spark.createDataFrame(rows(("r3", "p", 2, "c")), R)
    assert [ledger.apply(a), ledger.apply(b), ledger.apply(a), ledger.apply(a.unionByName(b))] == [2, 1, 0, 0]
    with pytest.raises(canonical.EvidenceError):
        ledger.apply(spark.createDataFrame(rows(("r1", "p", 1, "other"), ("r9", "z", 1, "z")), R))
    got = {r["receipt_id"]: r["disposition"] for r in ledger.result().collect()}
    full = {r["receipt_id"]: r["disposition"] for r in canonical.evidence(a.unionByName(b)).collect()}
    assert got == full


def test_deadline_flips_at_the_second(spark):
    days = spark.createDataFrame([(date(2026, 3, 2),)], "business_date date")
    none = spark.createDataFrame([], completeness.EVIDENCE.replace("\n", " "))
    for at, state in (("2026-03-03 00:59:59", "PENDING"), ("2026-03-03 01:00:00", "INCOMPLETE")):
        got = completeness.evaluate(completeness.spine(spark, days), none, F.lit(at).cast("timestamp"))
        assert {r["report_type"]: r["state"] for r in got.collect()}["payments"] == state
    assert completeness.all_complete(got, ("orders",)).first()[0] is False
    assert completeness.overall(got).first()[0] == "INCOMPLETE"


def test_late_classification(spark):
    t = lambda h: datetime(2026, 3, 5, h)
    c = "receipt_id string, entity_type string, source_id string, source_version long, received_at_utc timestamp, change_kind string"
    changes = spark.createDataFrame([("a", "PAYMENT", "p", 1, t(8), late.NEW), ("b", "PAYMENT", "p", 1, t(12), late.NEW), ("c", "PAYMENT", "p", 2, t(13), late.CORRECTION), ("d", "FEE", "f", 1, t(13), late.NEW), ("e", "PAYMENT", "p", 1, t(13), late.DUPLICATE), ("f", "PAYMENT", "p", 1, t(13), late.NEW), ("g", "PAYMENT", "p", 2, t(13), late.CONFLICT)], c)
    i = [(k, date(2026, 3, 2), None) for k in "abceg"] + [("c", date(2026, 4, 1), None), ("d", None, "no payment"), ("f", date(2026, 4, 1), None)]
    impacts = spark.createDataFrame(i, "receipt_id string, affected_date date, unresolved_reason string")
    got = {r["receipt_id"]: r for r in late.classify(late.candidates(changes, impacts), F.lit("run"), F.lit("2026-03-05 12:00:00").cast("timestamp"), F.lit("2026-03-31").cast("date")).collect()}
    assert {k: r["classification"] for k, r in got.items()} == {"a": "WITHIN_WATERMARK", "b": "WITHIN_WATERMARK", "c": "LATE_CORRECTION", "d": "UNRESOLVED_IMPACT", "e": "NO_LOGICAL_CHANGE", "f": "FUTURE_IMPACT", "g": "LATE_CONFLICT"}
    assert {k for k, r in got.items() if r["requires_reprocessing"]} == {"c", "d", "g"}
    assert got["c"]["affected_dates"] == [date(2026, 3, 2), date(2026, 4, 1)] and got["c"]["arrival_delay_seconds"] == 3600


def graph(spark, *records):
    return spark.createDataFrame([tuple(r.get(c) for c in impact.FIELDS) for r in records], ", ".join(f"{c} {t}" for c, t in impact.FIELDS.items()))


def test_affected_windows(spark):
    d = date(2026, 3, 2)
    o = lambda k: {"entity_type": "ORDER", "source_id": k}
    p = lambda k, ord_, day=d: {"entity_type": "PAYMENT", "source_id": k, "order_id": ord_, "status": "CAPTURED", "available_on": day}
    records = [o("o1"), o("o2"), o("o3"), p("p1", "o1"), p("p2", "o2"), p("p3", "o3", date(2026, 3, 9)), {"entity_type": "REFUND", "source_id": "r1", "payment_id": "p1", "status": "SUCCEEDED", "available_on": date(2026, 3, 3)}, {"entity_type": "PAYOUT", "source_id": "out", "payout_date": d}]
    all_ = graph(spark, *records)
    plan = impact.plan(all_, all_, graph(spark, records[6]), late.NEW)
    assert plan.scope == "WINDOWS" and plan.reason_codes == []
    # The payment's day is shared, so the other order on it is reached too; the third is not.
    assert sorted(r[0] for r in plan.order_ids().collect()) == ["o1", "o2"]
    assert [tuple(r) for r in plan.windows().collect()] == [(d, date(2026, 3, 4))]
    assert [r[0] for r in plan.payout_ids().collect()] == ["out"]
    lost = impact.plan(all_, all_, graph(spark, {"entity_type": "FEE", "source_id": "f", "payment_id": "gone"}), late.NEW)
    assert lost.scope == "FULL" and lost.reason_codes == ["RELATED_RECORD_MISSING:PAYMENT:gone"]
    assert impact.plan(all_, all_, all_, late.DUPLICATE).scope == "NONE"
    assert impact.plan(all_, all_, all_.limit(0), late.NEW).reason_codes == ["CHANGE_EVIDENCE_MISSING"]
    assert impact.plan(all_, all_, all_, late.NEW, completeness_changed=True).scope == "FULL"


def test_date_windows_join_over_a_year_end(spark):
    days = [date(2025, 12, 30), date(2025, 12, 31), date(2026, 1, 1), date(2026, 1, 3)]
    got = impact.date_windows(spark.createDataFrame([(x,) for x in days], "day date")).orderBy("start").collect()
    assert [tuple(r) for r in got] == [(date(2025, 12, 30), date(2026, 1, 2)), (date(2026, 1, 3), date(2026, 1, 4))]


@pytest.fixture(scope="module")
def result(spark):
    return run_scenario(spark, doc("r", {"exceptions": []}, **BASE)).result


def test_publish_and_crash(spark, result, tmp_path):
    store = Store(spark, "file://" + str(tmp_path))
    run = "scenario-r"
    first = store.publish(result, run)
    assert store.current() == first and store.verify_current() == first["fingerprint"]
    stop = recovery.FailOnce("before_pointer")
    with pytest.raises(recovery.InjectedFailure):
        store.publish(as_run(result, "again"), "again", before_commit=lambda _: stop("before_pointer"))
    assert store.current() == first and store.runs() == [run]
    assert publication.differing_sections(store.read_current(), result) == []
    result2 = run_scenario(spark, doc("r", {"exceptions": []}, **{**BASE, "orders": [order("120.00")]})).result
    assert publication.differing_sections(result, result2) == ["exceptions", "transactions"]


def test_violations(spark, result):
    from dataclasses import replace

    bad = replace(result, transactions=result.transactions.withColumn("collection_variance", F.lit("5.00").cast("decimal(18,2)")))
    assert [r["problem"] for r in publication.violations(bad, "scenario-r").collect()] == ["COLLECTION_VARIANCE"]
    twice = replace(result, payouts=result.payouts.unionByName(result.payouts))
    with pytest.raises(publication.PublicationError, match="KEY_NOT_UNIQUE"):
        MemoryStore().publish(twice, "scenario-r")
    with pytest.raises(publication.PublicationError):
        MemoryStore().publish(result, " ")
    assert "OTHER_RUN" in {r["problem"] for r in publication.violations(result, "another").collect()}


def test_fingerprints(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "k string, n long")
    f = lambda x: publication.fingerprint(x).first()[0]
    assert f(df) == f(df.orderBy(F.desc("n")).withColumn("run_id", F.lit("x"))) != f(df.distinct())
    with pytest.raises(TypeError):
        f(df.withColumn("x", F.lit(1.5)))


def test_conflict_references_are_stable(spark):
    out = run_scenario(spark, doc("c", {"exceptions": []}, payments=[payment(), payment("90.00")]))
    r = spark.createDataFrame(rows(("payments.json:1", "p1", 1, "a"), ("payments.json:2", "p1", 1, "b")), R)
    got = publication.stabilize_conflicts(out.result.exceptions, r).where("exception_type = 'CONFLICTING_SOURCE_VERSION'").first()
    assert len(got["supporting_source_record_ids"]) == 2 and all(x.startswith("source-variant:") for x in got["supporting_source_record_ids"])
    with pytest.raises(Exception, match="without a stored variant"):
        publication.stabilize_conflicts(out.result.exceptions, r.limit(0)).collect()


class Clock:
    def __init__(self):
        self.now = datetime(2026, 3, 5, tzinfo=timezone.utc)

    def __call__(self):
        return self.now


def test_queue(spark, tmp_path, result):
    clock = Clock()
    q = recovery.Queue(FileSystem(spark, "file://" + str(tmp_path)), clock)
    assert q.enqueue("k", "NEW", clock.now, canonical_changed=False) is None
    r = q.enqueue("k", "NEW", clock.now, max_attempts=2)
    assert q.enqueue("k", "NEW", clock.now).request_id == r.request_id and len(q.requests()) == 1
    assert q.next_ready().request_id == r.request_id
    store, fail = MemoryStore(), recovery.FailOnce("after_build")
    worker = recovery.Worker(q, store, lambda run_id, as_of: run_scenario(spark, {**doc("q", {"exceptions": []}, **BASE), "run_id": run_id}).result, fail)
    with pytest.raises(recovery.InjectedFailure):
        worker.run_next()
    assert store.current() is None and q.next_ready() is None and worker.run_next() is None
    clock.now += timedelta(seconds=31)
    assert recovery.drain(worker) == {"runs": [f"run-{r.request_id[:12]}-2"], "failed": 0, "stopped": "EMPTY"}
    assert q.get(r.request_id).status == "SUCCEEDED" and q.get("nothing") is None
    s = q.enqueue("k2", "NEW", clock.now, max_attempts=1)
    q.record_failure(s.request_id, ValueError("x"))
    assert q.get(s.request_id).status == "FAILED"
    q.requeue_failed(s.request_id, 1)
    assert q.next_ready().request_id == s.request_id
    with pytest.raises(recovery.QueueError):
        q.requeue_failed(s.request_id, 1)


def as_run(result, run_id):
    from dataclasses import replace

    own = {n: getattr(result, n).withColumn("run_id", F.lit(run_id)) for n in ("transactions", "payouts", "exceptions")}
    return replace(result, **own)


@pytest.mark.parametrize("point", recovery.FAILURE_POINTS)
def test_every_failure_point(spark, tmp_path, result, point):
    """Whatever breaks off, the request ends with one published result and is not run again after the pointer has moved."""
    clock = Clock()
    q, store, runs = recovery.Queue(FileSystem(spark, "file://" + str(tmp_path)), clock), MemoryStore(), []
    r = q.enqueue("k", "NEW", clock.now)

    def build(run_id, as_of):
        runs.append(run_id)
        return as_run(result, run_id)

    stop = recovery.FailOnce(point)
    worker = recovery.Worker(q, store, build, stop)
    try:
        worker.run_next()
    except recovery.InjectedFailure:
        clock.now += timedelta(seconds=31)
        worker.run_next()
    assert stop.fired and q.get(r.request_id).status == "SUCCEEDED" and store.current()["run_id"] == runs[-1]
    late = point in ("after_pointer", "before_complete", "after_commit")
    assert len(runs) == (1 if late or point == "after_claim" else 2) and worker.run_next() is None


def test_claims_are_exclusive(spark, tmp_path):
    clock = Clock()
    files = FileSystem(spark, "file://" + str(tmp_path))
    one, two = recovery.Queue(files, clock), recovery.Queue(files, clock)
    a, b = one.enqueue("a", "NEW", clock.now), two.enqueue("b", "NEW", clock.now)
    assert two.enqueue("a", "OTHER", clock.now).reason_code == "NEW" and len(one.requests()) == 2
    first, second = one.claim_next("x", 60), two.claim_next("y", 60)
    assert {first.request_id, second.request_id} == {a.request_id, b.request_id} and two.claim_next("z", 60) is None
    clock.now += timedelta(seconds=61)
    assert {two.claim_next("z", 60).request_id, one.claim_next("x", 60).request_id} == {a.request_id, b.request_id}
    assert one.claim_next("x", 60) is None


def test_rebuild_from_stored_evidence(spark, tmp_path):
    """Deliveries to ledger to requests to published result; a late refund gives a second one; lost rows are noticed."""
    from settleforge.plans import rebuild

    box = tmp_path / "box"
    box.mkdir()
    day = date(2026, 3, 2)
    for report, rows_ in BASE.items():
        deliveries.publish_source_file(box / f"{report}.json", rows_, report, str(day))
    deliveries.publish_source_file(box / "refunds.json", [], "refunds", str(day))
    clock = Clock()
    ledger = Ledger(spark, "file://" + str(tmp_path / "ledger"))
    q, store = recovery.Queue(FileSystem(spark, "file://" + str(tmp_path / "control")), clock), Store(spark, "file://" + str(tmp_path / "out"))
    findings, made = rebuild.ingest(ledger, q, deliveries.read_deliveries(spark, str(box)), clock.now)
    assert {r["state"] for r in findings.collect()} == {"READY"} and len(made) == 6
    assert rebuild.ingest(ledger, q, deliveries.read_deliveries(spark, str(box)), clock.now)[1] == []
    assert [r["business_date"] for r in ledger.expected_days().collect()] == [day]
    build = lambda run_id, as_of: rebuild.rebuild(ledger, run_id, as_of)
    done = recovery.drain(recovery.Worker(q, store, build), max_requests=1)
    assert done["failed"] == 0 and [r["state"] for r in store.read_current().transactions.collect()] == ["RECONCILED"]
    [run] = store.runs()
    seen = store.read_snapshot(run).collect()
    assert len(seen) == 6 and {(r["run_id"], r["state"], tuple(r["issue_codes"])) for r in seen} == {(run, "COMPLETE", ())}
    assert all(r["observed_at_utc"] == clock.now.replace(tzinfo=None) and r["deadline_utc"].date() == day + timedelta(days=1) for r in seen)
    said = rebuild.inspections(q, ledger, store).collect()
    assert sorted(r["action"] for r in said) == ["DO_NOT_REPEAT"] + ["RETRY_NOW"] * 5
    assert all(r["problem"] is None for r in said)
    odd = q.enqueue("elsewhere", "NEW", clock.now)
    assert {r["request_id"]: r["problem"] for r in rebuild.inspections(q, ledger, store).collect()}[odd.request_id] == "NOT_ON_COMMITTED_EVIDENCE"
    before = rebuild.input_fingerprint(ledger, clock.now)
    clock.now += timedelta(days=1)
    from test_scenarios import refund

    deliveries.publish_source_file(box / "late.json", [refund()], "refunds", "2026-03-03")
    assert len(rebuild.ingest(ledger, q, deliveries.read_deliveries(spark, str(box)), clock.now)[1]) == 1
    assert rebuild.input_fingerprint(ledger, clock.now) != before == rebuild.input_fingerprint(ledger, clock.now - timedelta(days=1))
    late = rebuild.rebuild(ledger, "late", clock.now)
    assert [str(r["successful_refund_total"]) for r in late.transactions.collect()] == ["30.00"]
    # The second day's other reports are expected now, and not there though their deadlines have passed.
    assert clock.now > datetime(2026, 3, 4, 12, tzinfo=timezone.utc)
    assert [r["state"] for r in late.transactions.collect()] == ["INCOMPLETE"]
    ungated = rebuild.rebuild(ledger, "free", clock.now, judge_reports=False)
    assert {r["state"] for r in ungated.transactions.collect()} <= {"RECONCILED", "EXCEPTION"}
    spark.read.parquet(ledger.files.root + "/receipts/FEE").limit(0).write.mode("overwrite").parquet(ledger.files.root + "/receipts/FEE2")
    ledger.files.delete("receipts/FEE")
    with pytest.raises(rebuild.EvidenceLost, match="ROWS_NOT_CONSERVED"):
        rebuild.rebuild(ledger, "lost", clock.now)


def test_failed_batches_stay_as_evidence(spark, tmp_path):
    """A delivery with a wrong count or checksum is kept, quarantined row by row; its day is expected, its report is not there."""
    from settleforge.plans import rebuild

    box = tmp_path / "box"
    box.mkdir()
    day = "2026-03-02"
    deliveries.publish_source_file(box / "orders.json", [order(), order(total="x", id="o2")], "orders", day)
    deliveries.publish_source_file(box / "fees.json", [], "fees", day)
    deliveries.publish_source_file(box / "gone.json", [{}], "payments", day)
    said = json.loads((box / "orders.manifest.json").read_text())
    (box / "orders.manifest.json").write_text(json.dumps({**said, "row_count": 5}))
    (box / "fees.json").write_text("[ ]")
    (box / "gone.json").write_text("{")
    clock = Clock()
    ledger = Ledger(spark, "file://" + str(tmp_path / "ledger"))
    q = recovery.Queue(FileSystem(spark, "file://" + str(tmp_path / "control")), clock)
    read = lambda: deliveries.read_deliveries(spark, str(box))
    # Before anything sound has come in there is nothing to rebuild, and no error.
    found, made = rebuild.ingest(ledger, q, read(), clock.now)
    assert made == [] and {r["reason"] for r in found.collect()} == {"ROW_COUNT_MISMATCH", "CHECKSUM_MISMATCH"}
    b = {r["report_type"]: (r["status"], r["error_message"], r["observed_row_count"]) for r in ledger.batches().collect()}
    assert b == {"orders": ("FAILED", "ROW_COUNT_MISMATCH", 2), "fees": ("FAILED", "CHECKSUM_MISMATCH", 0)}
    rows = {r["source_id"]: r["reason_code"] for r in ledger.quarantine().collect()}
    assert rows == {"o1": "BATCH_VALIDATION_FAILED", "o2": "INVALID_AMOUNT"} and ledger.receipts("ORDER").isEmpty()
    assert ledger.stored_batches().isEmpty() and rebuild.lost_evidence(ledger, clock.now).isEmpty()
    rebuild.ingest(ledger, q, read(), clock.now)
    assert ledger.batches().count() == 2 and ledger.quarantine().count() == 2
    ledger.expect(spark.createDataFrame([(date(2026, 3, 1),), (date(2026, 3, 2),)], "business_date date"))
    assert sorted(str(r[0]) for r in ledger.expected_days().collect()) == ["2026-03-01", "2026-03-02"]
    out = rebuild.rebuild(ledger, "r", datetime(2026, 3, 5, tzinfo=timezone.utc))
    assert {r["state"] for r in out.completeness.collect()} == {"INCOMPLETE"} and out.transactions.isEmpty()
    assert out.quarantine.count() == 2


def test_failure_after_the_pointer_is_not_repeated(spark, tmp_path):
    q, store = recovery.Queue(FileSystem(spark, "file://" + str(tmp_path)), Clock()), MemoryStore()
    r = q.enqueue("k", "NEW", q.clock())
    build = lambda run_id, as_of: run_scenario(spark, {**doc("q", {"exceptions": []}, **BASE), "run_id": run_id}).result
    assert recovery.Worker(q, store, build, recovery.FailOnce("after_pointer")).run_next() == store.current()["run_id"]
    assert q.get(r.request_id).status == "SUCCEEDED"


def test_gate_ledger_and_certification(spark, tmp_path):
    box = tmp_path / "box"
    box.mkdir()
    put = lambda n, rows_, report="orders": deliveries.publish_source_file(box / f"{n}.json", rows_, report, "2026-03-02")
    edit = lambda n, f: (box / f"{n}.manifest.json").write_text(json.dumps(f(json.loads((box / f"{n}.manifest.json").read_text()))))
    for n in ("good", "count", "version", "named", "flag", "changed", "writing", "nodata"):
        put(n, [order(id=n)])
    put("bad", [order(id="b"), order(total="x", id="c")])
    with pytest.raises(FileExistsError):
        put("good", [])
    edit("count", lambda m: {**m, "row_count": 3})
    edit("version", lambda m: {**m, "schema_version": "2"})
    edit("named", lambda m: {**m, "filename": "x.json"})
    edit("flag", lambda m: {**m, "row_count": True})
    (box / "changed.json").write_text("[]")
    (box / "writing.json.part").write_text("")
    (box / "nodata.json").unlink()
    (box / "alone.json").write_text("[]")
    for n, text in (("dup", '[{"a":1,"a":2}]'), ("obj", '{"a":1}'), ("ints", "[1]")):
        put(n, [{}])
        (box / f"{n}.json").write_text(text)
        import hashlib

        edit(n, lambda m, t=text: {**m, "checksum_sha256": hashlib.sha256(t.encode()).hexdigest()})
    found = deliveries.gate(deliveries.read_deliveries(spark, str(box))).persist()
    got = {r["stem"].rsplit("/", 1)[1]: (r["state"], r["reason"]) for r in found.collect()}
    rej = lambda x: ("REJECTED", x)
    assert got == {"good": ("READY", "VERIFIED"), "bad": ("READY", "VERIFIED"), "count": rej("ROW_COUNT_MISMATCH"), "version": rej("UNSUPPORTED_SCHEMA_VERSION"), "named": rej("INVALID_MANIFEST"), "flag": rej("INVALID_MANIFEST"), "changed": rej("CHECKSUM_MISMATCH"), "writing": ("WAITING", "TEMPORARY_FILE_PRESENT"), "nodata": ("WAITING", "DATA_FILE_MISSING"), "alone": ("WAITING", "MANIFEST_MISSING"), "dup": rej("INVALID_DATA_JSON"), "obj": rej("INVALID_DATA_STRUCTURE"), "ints": rej("INVALID_DATA_STRUCTURE")}
    with pytest.raises(deliveries.DeliveryError):
        deliveries.verify(found)
    faults = {r["stem"].rsplit("/", 1)[1]: r["fault"] for r in deliveries.judged(found).collect()}
    assert {k for k, v in faults.items() if v is None} == {"good", "bad"} and faults["changed"] == "CHECKSUM_MISMATCH"
    ledger, ready = Ledger(spark, "file://" + str(tmp_path / "ledger")), deliveries.verify(found.where("state = 'READY'"))
    # A crash between the appends leaves nothing that is read, and the next attempt completes it.
    stop = recovery.FailOnce("after_rows")
    with pytest.raises(recovery.InjectedFailure):
        ledger.ingest(ready, "2026-03-02 19:00:00", hook=stop)
    assert ledger.batches().isEmpty() and ledger.receipts("ORDER") is None and ledger.quarantine().isEmpty()
    assert ledger.stored_batches().isEmpty() and ledger.expected_days().isEmpty()
    assert ledger.ingest(ready, "2026-03-02 20:00:00") == 2
    assert ledger.ingest(ready, "2026-03-02 21:00:00") == 0
    assert sorted(r["order_id"] for r in ledger.current()["ORDER"].collect()) == ["b", "good"]
    assert [r["reason_code"] for r in ledger.quarantine().collect()] == ["INVALID_AMOUNT"]
    problems = {r["original_filename"]: r["problem"] for r in completeness.certify(ledger.stored_batches()).collect()}
    assert problems == {"good.json": None, "bad.json": "QUARANTINED_ROWS"}
    days = spark.createDataFrame([], "business_date date")
    state = completeness.stored_completeness(ledger.stored_batches(), days, F.lit("2026-03-04 00:00:00").cast("timestamp"))
    assert {r["report_type"]: r["reason"] for r in state.collect()}["fees"] == "REPORT_MISSING"
    with pytest.raises(ValueError):
        completeness.stored_completeness(ledger.stored_batches(), days, F.lit("2026-01-01").cast("timestamp"))


def test_empty_files_are_seen(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    (tmp_path / "b.json.part").write_text("")
    (tmp_path / "c.manifest.json").write_text("")
    got = {r["stem"].rsplit("/", 1)[1]: (r["state"], r["reason"]) for r in deliveries.gate(deliveries.read_deliveries(spark, str(tmp_path))).collect()}
    assert got == {"a": ("WAITING", "MANIFEST_MISSING"), "b": ("WAITING", "TEMPORARY_FILE_PRESENT"), "c": ("REJECTED", "INVALID_MANIFEST")}


def test_archive(tmp_path):
    f = tmp_path / "x.json"
    f.write_text("[]")
    sha = archive.checksum_of(f)
    target, again = archive.archive(tmp_path / "a", f, "orders", date(2026, 3, 2), sha)
    assert not again and target.exists() and not f.exists()
    f.write_text("[]")
    assert archive.archive(tmp_path / "a", f, "orders", date(2026, 3, 2), sha)[1]
    assert archive.restore(tmp_path / "a", "orders", date(2026, 3, 2), sha, f).read_text() == "[]"
    target.write_text("x")
    with pytest.raises(archive.ArchiveError):
        archive.archive(tmp_path / "a", f, "orders", date(2026, 3, 2), sha)
    with pytest.raises(ValueError):
        archive.relative_path("coupons", date(2026, 3, 2), sha)


def test_archive_is_retried(spark, tmp_path):
    f = tmp_path / "x.json"
    log = archive.ArchiveLog(FileSystem(spark, "file://" + str(tmp_path / "control")), tmp_path / "a", max_attempts=3)
    sha = __import__("hashlib").sha256(b"[]").hexdigest()
    assert log.request("k", f, "orders", date(2026, 3, 2), sha)["status"] == "PENDING"
    assert log.run()[0]["status"] == "FAILED" and "FileNotFoundError" in log.state("k")["error"]
    f.write_text("[]")
    assert log.request("k", f, "orders", date(2026, 3, 2), sha)["attempts"] == 1
    done = log.run()[0]
    assert done["status"] == "ARCHIVED" and done["attempts"] == 2 and not f.exists() and log.run() == []
    with pytest.raises(ValueError):
        log.request("q", f, "coupons", date(2026, 3, 2), sha)


def test_contract_manifests(spark):
    from settleforge.sources.validate import parse_manifests

    good = {"batch_id": "b", "source_system": "shop", "report_type": "orders", "business_date": "2026-03-02", "schema_version": 1, "generated_at_utc": "2026-03-02T10:00:00Z", "row_count": 0, "sha256": "a" * 64}
    cases = {"ok": good, "version": {**good, "schema_version": 2}, "type": {**good, "schema_version": "1"}, "sum": {**good, "sha256": "A" * 64}, "count": {**good, "row_count": -1}, "system": {**good, "source_system": "bank"}, "extra": {**good, "x": 1}, "none": {k: v for k, v in good.items() if k != "batch_id"}, "two": {**good, "schema_version": 2, "sha256": "x"}}
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in cases.items()] + [("json", "{")], "k string, payload string")
    valid, bad = parse_manifests(df)
    assert [(r["k"], r["manifest"]["row_count"], r["manifest"]["business_date"]) for r in valid.collect()] == [("ok", 0, date(2026, 3, 2))]
    assert {r["k"]: r["reason_code"] for r in bad.collect()} == {"version": "UNSUPPORTED_SCHEMA_VERSION", "type": "INVALID_TYPE", "sum": "INVALID_VALUE", "count": "INVALID_VALUE", "system": "INVALID_VALUE", "extra": "UNEXPECTED_FIELD", "none": "MISSING_FIELD", "two": "UNSUPPORTED_SCHEMA_VERSION", "json": "INVALID_JSON"}


def test_runner(spark, tmp_path):
    from settleforge.plans import runner

    assert runner.load_callable("json:dumps") is json.dumps
    for bad in ("json", "json:", ":dumps", "json:a:b"):
        with pytest.raises(ValueError):
            runner.load_callable(bad)
    with pytest.raises(TypeError):
        runner.load_callable("json:__name__")
    places = [f"--{n}=file://{tmp_path}/{n}" for n in ("control", "results", "ledger")]
    assert runner.main(places) == 0


def test_click_stream(spark, tmp_path):
    box = tmp_path / "in"
    box.mkdir()
    event = lambda **x: json.dumps({"event_type": "purchase", "user_id": 1, "product_id": None, "timestamp": "2026-03-02T10:00:00+05:00", **x})
    files = {"a": event(), "b": event(event_type="add_to_cart"), "zero": event(user_id=0), "flag": event(user_id=True), "type": event(event_type="error"), "time": event(timestamp="soon"), "number": event(timestamp=5), "product": event(product_id="7"), "none": "[1]", "broken": "{", "keys": '{"event_type":"purchase"}'}
    for n, t in files.items():
        (box / f"{n}.json").write_text(t)
    paths = [str(tmp_path / x) for x in ("events", "bad", "check")]
    clickstream.stream(spark, str(box), *paths).awaitTermination()
    (box / "c.json").write_text(event(timestamp="2026-03-02T10:00:29Z"))
    clickstream.stream(spark, str(box), *paths).awaitTermination()
    events = spark.read.parquet(paths[0])
    assert sorted(r["source_file"] for r in events.collect()) == ["a.json", "b.json", "c.json"]
    assert {r["source_file"][:-5]: r["reason"] for r in spark.read.parquet(paths[1]).collect()} == {"zero": "INVALID_USER", "flag": "INVALID_USER", "type": "INVALID_EVENT_TYPE", "time": "INVALID_TIMESTAMP", "number": "INVALID_TIMESTAMP", "product": "INVALID_PRODUCT", "none": "NOT_AN_OBJECT", "broken": "INVALID_JSON", "keys": "MISSING_FIELD"}
    at = lambda s: F.lit(f"2026-03-02 10:00:{s}").cast("timestamp")
    assert clickstream.cart_snapshot(events, at("00"), at("30")).select("user_id", "add_to_cart_count").collect() == [(1, 1)]
    q = clickstream.purchase_quantity(events, at("00"), at("29"))
    assert int(q.first()["total_quantity"]) == 1 and clickstream.has_purchases(q)
    assert not clickstream.has_purchases(clickstream.purchase_quantity(events, at("40"), at("50")))
    assert clickstream.report(q).first()[0] == "purchases at 2026-03-02 10:00:00: 1"
    mart = clickstream.upsert(clickstream.upsert(None, q, ["operation_timestamp"]), q, ["operation_timestamp"])
    assert mart.count() == 1
    made = clickstream.generate(spark, 50)
    assert clickstream.parse_events(made).where("reason IS NULL").count() == 50
    assert clickstream.ingest(made.unionByName(made), clickstream.ingest(made.limit(10))[0])[0].count() == 40


def test_marts_stream(spark, tmp_path):
    """Finished intervals are appended once; the last one waits for its watermark."""
    box = tmp_path / "in"
    rows_ = [("purchase", 1, f"2026-03-02 10:{m:02d}:{s:02d}") for m, s in ((0, 1), (0, 2), (0, 31), (30, 0))]
    df = spark.createDataFrame(rows_, "event_type string, user_id long, at string")
    df = df.select("event_type", "user_id", F.col("at").cast("timestamp").alias("event_timestamp"))
    df.write.parquet(str(box))
    events = spark.readStream.schema(df.schema).parquet(str(box))
    args = (str(tmp_path / "marts"), str(tmp_path / "checkpoint"))
    clickstream.stream_marts(events, *args).awaitTermination()
    got = spark.read.parquet(args[0])
    assert sorted((str(r["start"])[11:], r["n"]) for r in got.collect()) == [("10:00:00", 2), ("10:00:30", 1)]
    clickstream.stream_marts(events, *args).awaitTermination()
    assert spark.read.parquet(args[0]).count() == 2
    assert clickstream.cadence("30 seconds") == {"processingTime": "30 seconds"}


def test_registry(spark, sf):
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 50
    assert e.entry(spark).limit(1).count() == 1
