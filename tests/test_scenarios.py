"""Hand-calculated scenarios through the whole engine."""

import pytest

from settleforge.operators.canonical import EvidenceError
from settleforge.operators.reconcile import ReconciliationError
from settleforge.plans.scenarios import discover, run_scenario

DAY, AT = "2026-03-02", "2026-03-02T10:00:00+01:00"


def order(total="100.00", status="PAID", version=1, id="o1"):
    return {"order_id": id, "created_at_utc": AT, "status": status, "currency": "EUR", "order_total": total, "source_version": version}


def payment(amount="100.00", id="p1", order="o1", version=1):
    return {"payment_id": id, "order_id": order, "attempt_number": 1, "payment_method": "CARD", "status": "CAPTURED", "amount": amount, "currency": "EUR", "effective_at_utc": AT, "available_on": DAY, "source_version": version}


def fee(amount="2.00", id="f1", payment="p1"):
    return {"fee_id": id, "payment_id": payment, "fee_type": "PROCESSING", "amount": amount, "currency": "EUR", "effective_at_utc": AT, "available_on": DAY, "source_version": 1}


def refund(amount="30.00", id="r1", payment="p1", day="2026-03-03"):
    return {"refund_id": id, "payment_id": payment, "status": "SUCCEEDED", "amount": amount, "currency": "EUR", "effective_at_utc": AT, "available_on": day, "source_version": 1}


def line(amount, kind, movement, id=None, payout="out1"):
    return {"settlement_line_id": id or f"l-{movement}", "payout_id": payout, "movement_type": kind, "movement_id": movement, "signed_amount": amount, "currency": "EUR", "source_version": 1}


def payout(net="98.00", id="out1", day=DAY):
    return {"payout_id": id, "payout_date": day, "currency": "EUR", "reported_net_amount": net, "source_version": 1}


CLEAN_LINES = [line("100.00", "CAPTURE", "p1"), line("-2.00", "FEE", "f1")]
ALL = ("orders", "payments", "refunds", "fees", "settlement_lines", "payouts")


def doc(name, expected, as_of="2026-03-04T00:00:00Z", modes=None, **inputs):
    reports = {r: {"mode": "VALID", "received_at_utc": "2026-03-02T20:00:00Z"} for r in ALL}
    for r, m in (modes or {}).items():
        reports[r]["mode"] = m
    return {"scenario_id": name, "business_date": DAY, "as_of": as_of, "reports": reports, "inputs": inputs, "expected": expected}


def tx(state, codes=(), **more):
    return [{"order_id": "o1", "state": state, "exception_codes": list(codes), **more}]


def exc(*codes):
    return [{"exception_type": c, **m} for c, m in codes]


BASE = dict(orders=[order()], payments=[payment()], fees=[fee()], settlement_lines=CLEAN_LINES, payouts=[payout()])
SCENARIOS = [
    doc("g01-clean", {"transactions": tx("RECONCILED", lifetime_net_collection="98.00"), "payouts": [{"payout_id": "out1", "state": "RECONCILED", "expected_payout": "98.00"}], "exceptions": [], "expected_movements": [{"movement_type": "CAPTURE", "supporting_source_record_ids": ["provider:PAYMENT:p1"]}, {"movement_id": "f1", "signed_amount": "-2.00", "supporting_source_record_ids": ["provider:PAYMENT:p1", "provider:FEE:f1"]}]}, **BASE),
    doc("g02-no-capture", {"transactions": tx("EXCEPTION", ["MISSING_PAYMENT"], collection_variance="-64.30"), "exceptions": exc(("MISSING_PAYMENT", {"variance": "-64.30"}))}, orders=[order("64.30")]),
    doc("g03-pending", {"transactions": tx("PENDING"), "exceptions": []}, as_of="2026-03-03T00:30:00Z", modes={"payments": "MISSING"}, orders=[order()]),
    doc("g04-incomplete", {"transactions": tx("INCOMPLETE"), "exceptions": exc(("SOURCE_REPORT_MISSING", {"entity_id": "provider:payments:2026-03-02"}))}, as_of="2026-03-03T01:00:00Z", modes={"payments": "MISSING"}, orders=[order()]),
    doc("g05-short", {"transactions": tx("EXCEPTION", ["PAYMENT_AMOUNT_MISMATCH"], collection_variance="-20.00")}, **{**BASE, "orders": [order("120.00")]}),
    doc("g06-twice", {"evidence_summary": [{"duplicate": 1, "accepted": 6}], "transactions": tx("RECONCILED")}, **{**BASE, "payments": [payment(), payment()]}),
    doc("g07-conflict", {"evidence_summary": [{"conflicted": 2}], "exceptions": exc(("CONFLICTING_SOURCE_VERSION", {"entity_type": "PAYMENT", "entity_id": "p1", "supporting_source_record_ids": ["payments.json:1", "payments.json:2"]}), ("MISSING_PAYMENT", {}))}, orders=[order()], payments=[payment(), payment("90.00")]),
    doc("g08-two-captures", {"transactions": tx("EXCEPTION", ["MULTIPLE_CAPTURE", "PAYMENT_AMOUNT_MISMATCH"], captured_payment_count=2, collection_variance="100.00")}, orders=[order()], payments=[payment(), payment(id="p2")], fees=[fee(), fee(id="f2", payment="p2")]),
    doc("g09-orphan", {"exceptions": exc(("ORPHAN_PAYMENT", {"entity_id": "p1", "actual_amount": "48.20", "expected_amount": None, "variance": None}))}, payments=[payment("48.20")], fees=[fee("1.07")]),
    doc("g10-refund", {"transactions": tx("RECONCILED", lifetime_net_collection="68.00", successful_refund_total="30.00"), "exceptions": []}, **{**BASE, "refunds": [refund()]}),
    doc("g11-orphan-refund", {"exceptions": exc(("ORPHAN_REFUND", {"entity_id": "r1", "actual_amount": "41.70"}))}, refunds=[refund("41.70")]),
    doc("g12-excess", {"transactions": tx("EXCEPTION", ["EXCESS_REFUND"]), "exceptions": exc(("EXCESS_REFUND", {"variance": "10.00"}))}, **{**BASE, "refunds": [refund("60.00"), refund("50.00", id="r2")]}),
    doc("g14-fee", {"transactions": tx("EXCEPTION", ["FEE_MISMATCH"]), "payouts": [{"provider_report_variance": "0.00", "end_to_end_payout_variance": "-1.00", "state": "EXCEPTION", "exception_codes": []}], "exceptions": exc(("FEE_MISMATCH", {"variance": "1.00"}))}, **{**BASE, "fees": [fee("3.00")], "settlement_lines": [line("100.00", "CAPTURE", "p1"), line("-3.00", "FEE", "f1")], "payouts": [payout("97.00")]}),
    doc("g15-header", {"payouts": [{"exception_codes": ["PAYOUT_TOTAL_MISMATCH"], "provider_report_variance": "-0.60"}], "transactions": tx("RECONCILED")}, **{**BASE, "payouts": [payout("97.40")]}),
    doc("g16-missing-line", {"payouts": [{"exception_codes": ["MISSING_SETTLEMENT_LINE"], "end_to_end_payout_variance": "2.00"}]}, **{**BASE, "settlement_lines": CLEAN_LINES[:1], "payouts": [payout("100.00")]}),
    doc("g17-correction", {"transactions": tx("RECONCILED"), "evidence_summary": [{"stale": 2, "accepted": 6}]}, **{**BASE, "payments": [payment("90.00"), payment(version=2), payment("90.00")]}),
    doc("g19-quarantine", {"quarantine_records": [{"entity_type": "PAYMENT", "source_id": "p1", "reason_code": "INVALID_AMOUNT"}], "evidence_summary": [{"quarantined": 1, "accepted": 1}]}, orders=[order()], payments=[payment("ten euros")]),
    doc("cancelled", {"transactions": tx("EXCEPTION", ["CAPTURE_FOR_NON_PAYABLE_ORDER"], expected_collection="0.00"), "exceptions": exc(("CAPTURE_FOR_NON_PAYABLE_ORDER", {"actual_amount": "40.00", "supporting_source_record_ids": ["provider:PAYMENT:p2", "shop:ORDER:o1"]}))}, orders=[order(status="CANCELLED")], payments=[payment("60.00"), payment("40.00", id="p2")], fees=[fee("1.28"), fee("0.92", id="f2", payment="p2")]),
    doc("pending-with-capture", {"transactions": tx("RECONCILED", collection_variance="100.00")}, **{**BASE, "orders": [order(status="PAYMENT_PENDING")]}),
    doc("unexpected-fee", {"exceptions": exc(("UNEXPECTED_FEE", {"entity_id": "f9"}))}, **{**BASE, "fees": [fee(), fee("1.00", id="f9", payment="p9")]}),
    doc("two-fees", {"transactions": tx("RECONCILED"), "payouts": [{"exception_codes": ["MISSING_SETTLEMENT_LINE"]}], "exceptions": exc(("MISSING_SETTLEMENT_LINE", {"entity_id": "FEE:expected-fee:p1"}))}, **{**BASE, "fees": [fee("1.00"), fee("1.00", id="f2")]}),
    doc("wrong-payout", {"payouts": [{"payout_id": "out1", "exception_codes": ["MISSING_SETTLEMENT_LINE"]}, {"payout_id": "out2"}]}, **{**BASE, "settlement_lines": [CLEAN_LINES[0], line("-2.00", "FEE", "f1", payout="out2")], "payouts": [payout("100.00"), payout("0.00", id="out2", day="2026-03-05")]}),
    doc("duplicate-line", {"payouts": [{"exception_codes": ["DUPLICATE_SETTLEMENT_MOVEMENT"]}], "exceptions": exc(("DUPLICATE_SETTLEMENT_MOVEMENT", {"entity_id": "CAPTURE:p1", "actual_amount": "2.00"}))}, **{**BASE, "settlement_lines": [*CLEAN_LINES, line("100.00", "CAPTURE", "p1", id="again")], "payouts": [payout("198.00")]}),
    doc("line-amount", {"payouts": [{"exception_codes": ["SETTLEMENT_LINE_AMOUNT_MISMATCH"]}], "exceptions": exc(("SETTLEMENT_LINE_AMOUNT_MISMATCH", {"expected_amount": "-2.00", "actual_amount": "-2.01"}))}, **{**BASE, "settlement_lines": [CLEAN_LINES[0], line("-2.01", "FEE", "f1")], "payouts": [payout("97.99")]}),
    doc("bad-manifest", {"exceptions": exc(("SOURCE_REPORT_INVALID", {"entity_id": "provider:fees:2026-03-02"})), "transactions": tx("INCOMPLETE")}, modes={"fees": "ROW_COUNT_MISMATCH"}, **BASE),
]


@pytest.mark.parametrize("scenario", SCENARIOS, ids=lambda s: s["scenario_id"])
def test_scenario(spark, scenario):
    out = run_scenario(spark, scenario)
    assert out.passed, "\n".join(out.differences)


def test_hard_errors(spark):
    with pytest.raises(ReconciliationError, match="several payouts"):
        run_scenario(spark, doc("two-payouts", {}, **{**BASE, "payouts": [payout(), payout("1.00", id="out2")]}))
    rows = [{"receipt_id": "same", "payload": payment()}, {"receipt_id": "same", "payload": payment("1.00")}]
    with pytest.raises(EvidenceError, match="reused"):
        run_scenario(spark, doc("reuse", {}, payments=rows))


def test_discover(tmp_path):
    (tmp_path / "b.json").write_text("{}")
    (tmp_path / "a.json").write_text("{}")
    assert [p.name for p in discover(tmp_path)] == ["a.json", "b.json"]
