"""Strict JSON rows: valid records, and the first reason of each bad one."""

import collections
import json

import pytest

from settleforge.schemas import ENTITIES
from settleforge.sources.validate import validate, verdicts

PAYMENT = {"payment_id": "p-7", "order_id": "o-7", "attempt_number": 1, "payment_method": "WALLET", "status": "CAPTURED", "amount": "64.50", "currency": "EUR", "effective_at_utc": "2026-03-02T10:15:00+01:00", "available_on": "2026-03-03", "source_version": 1}
LINE = {"settlement_line_id": "l", "payout_id": "o", "movement_type": "FEE", "movement_id": "f", "signed_amount": "-2.00", "currency": "EUR", "source_version": 1}
DROP = object()


def change(base, **new):
    return json.dumps({k: v for k, v in {**base, **new}.items() if v is not DROP})


CASES = [
    ("PAYMENT", change(PAYMENT), None),
    ("PAYMENT", change(PAYMENT, status="FAILED", available_on=DROP), None),
    ("PAYMENT", change(PAYMENT, status="FAILED"), "INVALID_VALUE"),
    ("PAYMENT", change(PAYMENT, status="FAILED", available_on=None), "INVALID_VALUE"),
    ("PAYMENT", change(PAYMENT, available_on=DROP), "MISSING_FIELD"),
    ("PAYMENT", change(PAYMENT, order_id=DROP, extra=1), "MISSING_FIELD"),
    ("PAYMENT", change(PAYMENT, extra=1), "UNEXPECTED_FIELD"),
    ("PAYMENT", change(PAYMENT, status="LOST", amount="x"), "INVALID_VALUE"),
    ("PAYMENT", change(PAYMENT, amount="ten euros"), "INVALID_AMOUNT"),
    ("PAYMENT", change(PAYMENT, amount=64.5), "INVALID_AMOUNT"),
    ("PAYMENT", change(PAYMENT, amount="0.00"), "INVALID_AMOUNT"),
    ("PAYMENT", change(PAYMENT, currency="USD"), "UNSUPPORTED_CURRENCY"),
    ("PAYMENT", change(PAYMENT, attempt_number=True), "INVALID_TYPE"),
    ("PAYMENT", change(PAYMENT, attempt_number=1.0), "INVALID_TYPE"),
    ("PAYMENT", change(PAYMENT, source_version=0), "INVALID_VALUE"),
    ("PAYMENT", change(PAYMENT, source_version="1"), "INVALID_TYPE"),
    ("PAYMENT", change(PAYMENT, order_id=" o"), "INVALID_VALUE"),
    ("PAYMENT", change(PAYMENT, order_id=None), "INVALID_TYPE"),
    ("PAYMENT", change(PAYMENT, effective_at_utc="2026-03-02T10:15:00"), "INVALID_VALUE"),
    ("PAYMENT", change(PAYMENT, available_on="2026-3-3"), "INVALID_VALUE"),
    ("PAYMENT", '{"payment_id": 1, "payment_id": 2}', "INVALID_JSON"),
    ("PAYMENT", '{"payment_id": NaN}', "INVALID_JSON"),
    ("PAYMENT", "[1]", "INVALID_TYPE"),
    ("SETTLEMENT_LINE", change(LINE), None),
    ("SETTLEMENT_LINE", change(LINE, signed_amount="2.00"), "INVALID_MONEY_SIGN"),
    ("SETTLEMENT_LINE", change(LINE, signed_amount="0.00"), "INVALID_MONEY_SIGN"),
    ("SETTLEMENT_LINE", change(LINE, movement_type="CAPTURE"), "INVALID_MONEY_SIGN"),
    ("SETTLEMENT_LINE", change(LINE, movement_type="CAPTURE", signed_amount="2.00"), None),
    ("PAYOUT", '{"payout_id":"o","payout_date":"2026-03-03","currency":"EUR","reported_net_amount":"0.00","source_version":1}', None),
    ("PAYOUT", '{"payout_id":"o","payout_date":"2026-03-03","currency":"EUR","reported_net_amount":"-1.00","source_version":1}', "INVALID_AMOUNT"),
    ("ORDER", '{"order_id":"o","created_at_utc":"2026-03-03T00:00:00Z","status":"PAID","currency":"EUR","order_total":"1.00","source_version":1}', None),
    ("REFUND", '{"refund_id":"r","payment_id":"p","status":"SUCCEEDED","amount":"1.00","currency":"EUR","effective_at_utc":"2026-03-03T00:00:00Z","available_on":"2026-03-04","source_version":1}', None),
    ("FEE", '{"fee_id":"f","payment_id":"p","fee_type":"PROCESSING","amount":"1.00","currency":"EUR","effective_at_utc":"2026-03-03T00:00:00Z","available_on":"2026-03-04","source_version":1}', None),
]


@pytest.mark.parametrize("entity", ["PAYMENT", "SETTLEMENT_LINE", "PAYOUT", "ORDER", "REFUND", "FEE"])
def test_reasons(spark, entity):
    cases = [(str(i), text, code) for i, (e, text, code) in enumerate(CASES) if e == entity]
    good, bad = validate(spark.createDataFrame([c[:2] for c in cases], "receipt_id string, payload string"), entity)
    got = {r["receipt_id"]: r["reason_code"] for r in bad.collect()}
    assert got == {i: c for i, _, c in cases if c}
    assert {r["receipt_id"] for r in good.collect()} == {i for i, _, c in cases if not c}


def test_hash_depends_on_the_record_alone(spark):
    a, b = change(PAYMENT), json.dumps(dict(reversed(PAYMENT.items())))
    c = change(PAYMENT, effective_at_utc="2026-03-02T09:15:00Z")
    good, _ = validate(spark.createDataFrame([(a,), (b,), (c,), (change(PAYMENT, amount="64.51"),)], "payload string"), "PAYMENT")
    assert len({r["payload_hash"] for r in good.collect()}) == 2


def test_quarantine_keeps_text_ids_only(spark):
    _, bad = validate(spark.createDataFrame([(change(PAYMENT, amount="x"),), (change(PAYMENT, payment_id=5),)], "payload string"), "PAYMENT")
    assert {r["source_id"] for r in bad.collect()} == {"p-7", None}
    with pytest.raises(ValueError, match="UNSUPPORTED_ENTITY_TYPE"):
        validate(bad, "COUPON")


def test_quarantine_reasons_reads_every_line(spark, sf):
    from settleforge.queries import quarantine_reasons

    codes = {0: "INVALID_AMOUNT", 1: "INVALID_TYPE", 2: "UNSUPPORTED_CURRENCY"}
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").collect()
    want = collections.Counter(("-".join(map(str, r)), codes[r["l_partkey"] % 5]) for r in lines if r["l_partkey"] % 5 in codes)
    got = {(r["id"], r["reason_code"]): r["n"] for r in quarantine_reasons(spark, sf).collect()}
    assert got == want and any(r["l_partkey"] % 7 >= 2 for r in lines)


def test_rows_are_parsed_and_judged_once(spark, sf):
    """Neither half of the split, nor a filter on it, carries the checks again; verdicts agree with the halves."""
    from settleforge import queries

    for name in ("parsed_payments", "quarantine_reasons"):
        plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lower().count("parse_json") == 1 or plan.count("parseJson") == 1
    texts = ['{"payout_id":"p","payout_date":"2020-01-02","currency":"EUR","reported_net_amount":"1.00","source_version":1}',
             '{"payout_id":"p","payout_id":"q"}', "[1]", "null", "{}", '{"payout_id":null}', '{"payout_id":7,"x":1}', None, "",
             '{"payout_id":"","payout_date":"2020-01-02","currency":"EUR","reported_net_amount":"1.00","source_version":1}',
             '{"payout_id":"p","payout_date":"2020-01-02","currency":"EUR","reported_net_amount":"1.00","source_version":1.0}']
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, payload string")
    good, bad = validate(rows, "PAYOUT")
    want = {r["n"]: None for r in good.collect()} | {r["n"]: r["reason_code"] for r in bad.collect()}
    assert want == {r["n"]: r["reason_code"] for r in verdicts(rows, "PAYOUT").collect()}
    assert want == {
        0: None, 1: "INVALID_JSON", 2: "INVALID_TYPE", 3: "INVALID_TYPE", 4: "MISSING_FIELD", 5: "MISSING_FIELD",
        6: "MISSING_FIELD", 7: "INVALID_JSON", 8: "INVALID_JSON", 9: "INVALID_VALUE", 10: "INVALID_TYPE"
    }


def test_checks_are_compiled(spark):
    """No check is a function over array elements, which Spark would interpret together with all that it is worked out with."""
    for entity in ENTITIES:
        rows = spark.createDataFrame([("{}",)], "payload string")
        plan = verdicts(rows, entity)._jdf.queryExecution().executedPlan().toString()
        assert "lambda" not in plan and "array_sort" not in plan
