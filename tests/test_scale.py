"""What grows with the input is shuffled, written and judged once."""

from settleforge import fixtures, queries
from settleforge.operators import canonical
from settleforge.plans.checkpoints import saved


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_receipts_are_shuffled_once(spark, sf):
    """Removing repeats, versions and representatives share one exchange, and it carries no hash."""
    r = fixtures.payment_receipts(spark, sf)
    for df in (
        queries.QUERIES["canonical_payments"](spark, sf), queries.QUERIES["evidence_dispositions"](spark, sf),
        canonical.evidence(canonical.unique_receipts(r, canonical.IDENTITY))
    ):
        plan = _plan(df)
        assert plan.count("Exchange") == 1
        below = plan[plan.index("Exchange"):]
        assert "sha2" not in below and "receipt_id" not in below


def test_rules_read_current_payments_that_are_written(spark, sf):
    """A rule's plan does not make the current payments again for each of its inputs."""
    for name in ("payment_mismatches", "duplicate_settlement", "payout_total_mismatches", "date_windows", "impact_dates"):
        plan = _plan(queries.QUERIES[name](spark, sf))
        assert "l_linenumber" not in plan and "Window [row_number() windowspecdefinition(source_system" not in plan


def test_rules_read_all_payments_that_they_need(spark, sf):
    """Failed payments without a fee change no result."""
    a, b = (fixtures.inputs(spark, sf, saved, failed=f) for f in (True, False))
    assert a.payments.count() > b.payments.count()
    for n in ("orders", "refunds", "fees", "lines", "payouts"):
        x, y = getattr(a, n), getattr(b, n)
        assert x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()
    x, y = (i.payments.where("status = 'CAPTURED'") for i in (a, b))
    assert x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()


def test_receipts_lose_repeats_before_they_are_named(spark, sf):
    """Rows without names are sorted for repeats, and two windows judge what is left."""
    for name in ("canonical_payments", "evidence_dispositions"):
        plan = _plan(queries.QUERIES[name](spark, sf))
        assert plan.count("Window [") == 2
        assert "first(payment_id" not in plan and "first(source_system" not in plan and "first(status" not in plan


def test_conflicts_without_hash_or_version(spark):
    """A payload without a hash makes no conflict, and one without a version is never the highest."""
    rows = [("a", 2, None, "r1"), ("a", 2, "x", "r2"), ("b", 2, "x", "r3"), ("b", 2, "y", "r4"), ("b", 2, None, "r5"),
            ("c", None, "x", "r6"), ("c", 1, "y", "r7"), ("d", -(2**63), "x", "r8"), ("d", 1, "x", "r9")]
    r = spark.createDataFrame(rows, "source_id string, source_version long, payload_hash string, receipt_id string")
    r = r.selectExpr("*", "'provider' AS source_system", "'PAYMENT' AS entity_type")
    got = {x["receipt_id"]: x["disposition"] for x in canonical.evidence(r).collect()}
    assert got["r1"] == got["r2"] == "ACCEPTED" and {got[k] for k in ("r3", "r4", "r5")} == {"CONFLICTED"}
    assert got["r7"] == got["r9"] == "ACCEPTED" and got["r8"] == "STALE"


def test_receipts_are_settled_in_tasks_of_bounded_rows(spark, sf):
    """Tasks are counted by rows, which nothing merges again; Spark's own count goes by compressed bytes."""
    plan = fixtures.payment_receipts(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "REPARTITION_BY_COL" not in plan
    rows = 600_000
    assert [fixtures.receipt_tasks(rows * k, 12) for k in (0, 1, 6, 60, 360, 3600)] == [12, 12, 18, 180, 216, 2160]


def test_receipts_are_read_in_tasks_of_bounded_rows(spark, sf, monkeypatch):
    """Where map tasks sort what they write, they are as many as those that settle; else the session is left alone."""
    name, cost = "spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes"
    tasks = lambda: spark.read.parquet(f"{sf}/lineitem.parquet").rdd.getNumPartitions()
    spark.conf.set(cost, "1")
    try:
        fixtures.payment_receipts(spark, sf)
        assert spark.conf.get(name, None) is None and tasks() < 20
        a = fixtures.payment_receipts(spark, sf).select("receipt_id", "payload_hash").collect()
        for k, v in (("ROWS", 200), ("MOST_ROWS", 200), ("DIRECT", 10)):
            monkeypatch.setattr(fixtures, k, v)
        b = fixtures.payment_receipts(spark, sf).select("receipt_id", "payload_hash").collect()
        assert tasks() >= 30 and sorted(a) == sorted(b)
        fixtures.bound_scan(spark, 5)
        assert tasks() >= 30
    finally:
        spark.conf.unset(name)
        spark.conf.unset(cost)


def test_receipts_are_settled_raw(spark, sf):
    """Below the windows that choose current payments no text of a payment but its id is made."""
    plan = _plan(fixtures.inputs(spark, sf, settled=False, ordered=False).payments)
    below = plan[plan.index("Window ["):]
    assert "ORD-" in plan and not any(x in below for x in ("ORD-", "WALLET", "CAPTURED", "EUR"))


def test_merged_exceptions_carry_no_supports(spark, sf):
    """What the query leaves out is not gathered before."""
    plan = _plan(queries.QUERIES["exceptions_all"](spark, sf))
    assert "supporting_source_record_ids" not in plan and ":SETTLEMENT_LINE:" not in plan


def test_movements_are_made_into_lines_once(spark, sf):
    """Lines that come twice are doubled as rows; movements and their join are not made a second time for them."""
    i = fixtures.inputs(spark, sf, settled=False, ordered=False, failed=False)
    assert _plan(i.lines).count("Union") == 1
    assert i.lines.where("endswith(settlement_line_id, '-2')").count() > 0


def test_runs_are_compared_in_one_shuffle_without_a_sort(spark):
    """Rows of both runs are shuffled once and counted by hashing; rows that repeat count."""
    from settleforge.operators.publication import differing_rows

    rows = lambda *x: spark.createDataFrame(list(x), "order_id string, a string, b string")
    a = rows(("k", "1", "2"), ("gone", "1", None), ("null", None, "1"), ("twice", "r", "r"), ("twice", "r", "r"), ("bag", "p", ""), ("bag", "q", ""), (None, "z", ""))
    b = rows(("k", "1", "2"), ("new", "1", None), ("null", "1", None), ("twice", "s", "s"), ("twice", "s", "s"), ("bag", "q", ""), ("bag", "p", ""), (None, "z", ""))
    out = differing_rows(a, b, "transactions")
    assert {(r["key"], r["change"]) for r in out.collect()} == {("gone", "REMOVED"), ("new", "ADDED"), ("null", "CHANGED"), ("twice", "CHANGED")}
    whole = {(r["key"], r["change"]) for r in differing_rows(a, b.unionByName(b.limit(1)), "quarantine").collect()}
    assert ('{"a":"1","b":"2","order_id":"k"}', "CHANGED") in whole and ('{"a":"q","b":"","order_id":"bag"}', "CHANGED") not in whole
    plan = _plan(out)
    assert plan.count("Exchange") == 1 and "Join" not in plan and "SortAggregate" not in plan
