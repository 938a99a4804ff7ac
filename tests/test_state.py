"""Keyed state, timers, interval marts and the history of runs: against what all rows at once give, and what they read and write."""

import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from settleforge.operators import canonical, completeness, late
from settleforge.streaming import clickstream, deadlines
from settleforge.streaming import receipts as receipt_stream
from settleforge.streaming.state import MAX_FILES, EvidenceState

R = "receipt_id string, source_system string, entity_type string, source_id string, source_version long, payload_hash string, at timestamp"
AT = datetime(2026, 3, 2)


def receipts(r, n, start=0):
    return [
        (f"r{start + k}", "provider", r.choice(["FEE", "PAYMENT"]), f"e{r.randrange(12)}", r.randrange(1, 4), r.choice("abc"), AT + timedelta(seconds=r.randrange(50)))
        for k in range(n)
    ]


def kinds(df):
    return {r["receipt_id"]: r["disposition"] for r in df.collect()}


@pytest.mark.parametrize("first_seen", [None, "at"])
def test_state_equals_all_at_once(spark, tmp_path, first_seen):
    r = random.Random(4)
    batches = [receipts(r, 25, 100 * k) for k in range(4)]
    batches[2] += batches[0][:10]  # an exact replay
    state, seen = EvidenceState(spark, "file://" + str(tmp_path), 4, first_seen), []
    for k, rows in enumerate(batches):
        state.apply(spark.createDataFrame(rows, R), k)
        seen += [x for x in rows if x not in seen]
        want = kinds(canonical.evidence(spark.createDataFrame(seen, R), first_seen))
        got = EvidenceState(spark, "file://" + str(tmp_path), 4, first_seen)
        assert kinds(got.dispositions()) == want
    assert state.receipts().count() == len(seen)
    assert state.vacuum() > 0 and kinds(state.dispositions()) == want


def test_changes_and_batches_that_come_again(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame([(i, "provider", "PAYMENT", e, v, h, AT) for i, e, v, h in x], R)
    state = EvidenceState(spark, "file://" + str(tmp_path), 8)
    state.apply(rows(("r1", "p", 2, "a"), ("r2", "p", 2, "b"), ("r3", "q", 1, "a")), 5)
    new = rows(("r1", "p", 2, "a"), ("n1", "p", 3, "b"), ("n2", "p", 2, "a"), ("n3", "p", 2, "b"), ("n4", "p", 2, "z"), ("n5", "p", 1, "q"), ("n6", "n", 1, "n"))
    want = {"n1": late.CORRECTION, "n2": late.DUPLICATE, "n3": late.DUPLICATE, "n4": late.CONFLICT, "n5": late.STALE, "n6": late.NEW}
    for _ in range(2):  # the second time after a crash that Spark knows nothing of
        again = EvidenceState(spark, "file://" + str(tmp_path))
        assert {r["receipt_id"]: r["change_kind"] for r in again.apply(new, 6).collect()} == want
    assert again.receipts().count() == 9
    with pytest.raises(ValueError, match="long ago"):
        again.apply(new, 4)
    before = again.manifest
    for bad in (rows(("r3", "q", 2, "a")), rows(("x", "q", 1, "a"), ("x", "q", 1, "b"))):
        with pytest.raises(canonical.EvidenceError):
            again.apply(bad)
    assert EvidenceState(spark, "file://" + str(tmp_path)).manifest == before


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    state = EvidenceState(spark, "file://" + str(tmp_path), 32)
    many = [(f"r{k}", "provider", "FEE", f"e{k}", 1, "a", AT) for k in range(300)]
    state.apply(spark.createDataFrame(many, R))
    before = dict(state.manifest["state"])
    assert len(before) == 32
    state.apply(spark.createDataFrame([("x", "provider", "FEE", "e7", 2, "b", AT)], R))
    moved = [b for b, p in state.manifest["state"].items() if before[b] != p]
    assert len(moved) == 1 and state.state().count() == 300
    for k in range(MAX_FILES + 2):
        state.apply(spark.createDataFrame([(f"y{k}", "provider", "FEE", "e7", 2, "b", AT)], R))
    assert max(len(p) for p in state.manifest["ids"].values()) <= MAX_FILES and state.receipts().count() == 301 + MAX_FILES + 2
    assert EvidenceState(spark, "file://" + str(tmp_path / "none")).dispositions().collect() == []


def test_receipt_stream(spark, tmp_path):
    r = random.Random(8)
    rows, box, got = receipts(r, 30), tmp_path / "in", []
    spark.createDataFrame(rows[:20], R).write.parquet(str(box))
    args = (str(tmp_path / "state"), str(tmp_path / "checkpoint"), lambda c, k: got.append((k, c.count())))
    read = lambda: spark.readStream.schema(spark.createDataFrame([], R).schema).parquet(str(box))
    receipt_stream.stream(read(), *args).awaitTermination()
    spark.createDataFrame(rows[15:], R).write.mode("append").parquet(str(box))
    receipt_stream.stream(read(), *args).awaitTermination()
    assert got == [(0, 20), (1, 10)]
    assert kinds(EvidenceState(spark, args[0]).dispositions()) == kinds(canonical.evidence(spark.createDataFrame(rows, R)))


DAYS = [date(2026, 3, 28), date(2026, 3, 29), date(2026, 10, 24)]  # summer time begins and ends among them


def evidence(spark):
    """Reports that are complete in time, complete late, wrong, and not there at all."""
    rows = []
    for k, d in enumerate(DAYS):
        noon = datetime(d.year, d.month, d.day, 12, tzinfo=timezone.utc)
        for report, hours in (("orders", 2), ("payments", 40), ("fees", 30), ("payouts", None)):
            if hours is not None:
                at = noon + timedelta(hours=hours)
                n = 5 if report != "fees" else 6
                system = "shop" if report == "orders" else "provider"
                rows.append((report, d, True, "b", system, report, d, at - timedelta(minutes=k), 5, "s", True, None, "b", system, report, d, at, at, n, "s"))
    return spark.createDataFrame(rows, completeness.EVIDENCE)


def test_deadlines_pass_without_rows(spark, tmp_path):
    days, box = spark.createDataFrame([(d,) for d in DAYS], "business_date date"), str(tmp_path / "in")
    events = deadlines.report_events(days, evidence(spark), F.col("business_date").cast("timestamp"))
    events = events.withColumnRenamed("at", "t").collect()
    due = {(r["report_type"], r["business_date"]): r["deadline"] for r in events}
    assert len(due) == 18
    feed = spark.createDataFrame([], deadlines.EVENT).schema
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run(until, since):
        """The clock moves from one time to another; what came in between, and one tick, is taken up."""
        rows = [tuple(r) for r in events if since < r["t"] <= until]
        spark.createDataFrame(rows, feed).coalesce(1).write.mode("append").parquet(box)
        spark.range(1).select(*deadlines.tick(F.lit(until))).coalesce(1).write.mode("append").parquet(box)
        stream = deadlines.changes(spark.readStream.schema(feed).parquet(box))
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start().awaitTermination()

    limit, start = due["payouts", DAYS[0]], datetime(2026, 3, 1)
    for moment in (limit - timedelta(microseconds=1), limit, datetime(2026, 3, 31, 5), datetime(2026, 11, 1)):
        run(moment, start)
        start = moment
        got = deadlines.states(spark.read.schema(deadlines.CHANGE).parquet(out), F.lit(moment)).collect()
        seen = [d for d in DAYS if datetime(d.year, d.month, d.day) <= moment]
        known = spark.createDataFrame([(d,) for d in seen], "business_date date")
        want = completeness.evaluate(completeness.spine(spark, known), evidence(spark), F.lit(moment)).collect()
        key = lambda rows: {(r["report_type"], r["business_date"]): r["state"] for r in rows}
        assert key(got) == key(want)
    changed = spark.read.schema(deadlines.CHANGE).parquet(out).collect()
    late_ones = [r for r in changed if r["state"] == "INCOMPLETE"]
    # Each at its own deadline to the microsecond, though no row came then.
    assert late_ones and all(r["at"] == due[r["report_type"], r["business_date"]] for r in late_ones)
    payments = sorted((r["at"], r["state"]) for r in changed if (r["report_type"], r["business_date"]) == ("payments", DAYS[0]))
    assert [s for _, s in payments] == ["PENDING", "INCOMPLETE", "COMPLETE"]


def test_intervals_and_marts(spark, tmp_path):
    rows = [("purchase", 1, "2026-03-02 00:00:00"), ("purchase", 2, "2026-03-02 23:59:59.9"), ("add_to_cart", 3, "2026-03-02 10:00:29"), ("purchase", 1, "2026-03-04 12:00:30")]
    df = spark.createDataFrame(rows, "event_type string, user_id long, t string")
    df = df.select("event_type", "user_id", F.col("t").cast("timestamp").alias("event_timestamp"))
    days = spark.createDataFrame([(date(2026, 3, d),) for d in (2, 3, 4)], "day date")
    got = {str(r[0]): int(r[1]) for r in clickstream.purchase_intervals(df, days).collect()}
    assert len(got) == 3 * 2880 and {t: n for t, n in got.items() if n} == {
        "2026-03-02 00:00:00": 1, "2026-03-02 23:59:30": 1, "2026-03-04 12:00:30": 1
    }
    # Intervals that do not divide a day begin on one of them, each once.
    odd = [r[0] for r in clickstream.interval_spine(days, "7 seconds").collect()]
    assert len(odd) == len(set(odd)) and len(odd) in (37028, 37029)
    step = df.select(F.window("event_timestamp", "7 seconds").alias("w")).select("w.start").collect()
    assert {r[0] for r in step if r[0] >= AT} <= set(odd)
    assert len({str(r[0]) for r in clickstream.interval_spine(days, "2 days").collect()}) in (1, 2)
    mart = clickstream.Mart(spark, str(tmp_path / "mart"), "operation_timestamp")
    mart.write(clickstream.purchase_intervals(df, days))
    stamp = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "mart").glob("day=*/*.parquet")}
    before = stamp()
    late_one = df.limit(0).unionByName(df.where("user_id = 2").withColumn("event_timestamp", F.lit("2026-03-03 08:00:01").cast("timestamp")))
    made = mart.correct(late_one, df.unionByName(late_one), clickstream.purchase_intervals)
    assert [str(r[0]) for r in made.collect()] == ["2026-03-03"]
    after = stamp()
    assert {p.parent.name for p in after.keys() ^ before.keys()} == {"day=2026-03-03"}
    assert sum(int(r[1]) for r in mart.read().collect()) == 4 and mart.read().count() == 3 * 2880
    carts = clickstream.cart_intervals(df).collect()
    assert [(r["user_id"], str(r["snapshot_hour"]), r["add_to_cart_count"]) for r in carts] == [(3, "2026-03-02 10:00:00", 1)]
    q = clickstream.purchase_quantity(df, F.lit(AT), F.lit(AT + timedelta(days=1)))
    assert clickstream.write_report(spark, q, str(tmp_path / "report"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "report")).collect()] == ["purchases at 2026-03-02 00:00:00: 2"]
    none = clickstream.purchase_quantity(df, F.lit(AT - timedelta(days=9)), F.lit(AT - timedelta(days=8)))
    assert not clickstream.write_report(spark, none, str(tmp_path / "no-report")) and not (tmp_path / "no-report").exists()


def test_runs_that_were_current(spark):
    at = lambda h, m=0: AT + timedelta(hours=h, minutes=m)
    runs = [("a", at(1)), ("b", at(1, 30)), ("c", at(1, 30)), ("d", at(26)), ("e", at(27))]
    df = spark.createDataFrame([(i, t, t, AT.date()) for i, t in runs], "run_id string, published_at_utc timestamp, input_watermark_utc timestamp, covered_through_date date")
    times = [None, at(0), at(0, 59), at(1), at(1, 29), at(1, 30), at(2), at(25, 59), at(26), at(26, 1), at(27), at(100)]
    got = late.current_runs(spark.createDataFrame(list(enumerate(times)), "k long, received_at_utc timestamp"), df).collect()
    want = {k: max(((p, i) for i, p in runs if t and p <= t), default=(None, None))[1] for k, t in enumerate(times)}
    assert {r["k"]: r["run_id"] for r in got} == want and len(got) == len(times)
    assert late.current_runs(spark.createDataFrame([(1, AT)], "k long, received_at_utc timestamp"), df.limit(0)).first()["run_id"] is None


def test_a_batch_reads_its_rows_and_the_known_ids_once(spark, tmp_path, monkeypatch):
    """What is new, what is known and ids used twice come out of one pass; untouched entities of a bucket stay as they are."""
    state, n = EvidenceState(spark, "file://" + str(tmp_path / "s"), buckets=1), []
    row = lambda k, v, h: (f"r{k}{v}{h}", "provider", "PAYMENT", k, v, h)
    frame = lambda rows: spark.createDataFrame(rows, "receipt_id string, source_system string, entity_type string, source_id string, source_version long, payload_hash string")
    state.apply(frame([row("a", 1, "x"), row("b", 2, "y"), row("b", 2, "z")]))
    before = {r["source_id"]: r for r in state.state().collect()}
    kind = type(state.state())
    join = kind.join
    monkeypatch.setattr(kind, "join", lambda *a, **k: n.append(1) or join(*a, **k))
    state.apply(frame([row("a", 3, "w"), row("b", 2, "y")]))
    monkeypatch.undo()
    after = {r["source_id"]: r for r in state.state().collect()}
    assert len(n) == 1 and after["b"] == before["b"] and after["a"]["source_version"] == 3


def test_what_is_known_is_not_shuffled(spark, tmp_path, monkeypatch):
    """A batch is dealt out once, as files; from there on a bucket is a task of its own that reads what is known beside the batch."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    state, r, plans = EvidenceState(spark, "file://" + str(tmp_path), 3), random.Random(5), []
    batches = [spark.createDataFrame(receipts(r, 40, 100 * k), R) for k in range(2)]
    writer = type(batches[0].write)
    write = writer.parquet
    monkeypatch.setattr(writer, "parquet", lambda w, *a, **k: plans.append(plan(w._df)) or write(w, *a, **k))
    for batch in batches:
        state.apply(batch)
    monkeypatch.undo()
    assert len(plans) >= 8 and not any("Exchange" in p for p in plans)
    out = state.dispositions()
    assert "Exchange" not in plan(out) and out.rdd.getNumPartitions() == 3
    assert kinds(out) == kinds(canonical.evidence(batches[0].unionByName(batches[1])))
    # An id that is known of one entity is refused for any other, in whatever bucket that lies.
    before = state.manifest
    for k in range(6):
        with pytest.raises(canonical.EvidenceError, match="r7"):
            state.apply(spark.createDataFrame([("r7", "provider", "FEE", f"other{k}", 1, "a", AT)], R))
    assert state.manifest == before
