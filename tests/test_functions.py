"""Scalar functions: money, fees, instants, identities."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from settleforge.functions import identity, money, times


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_money_shapes(spark):
    good = {"0.00": "0.00", "19.99": "19.99", "9999999999999999.99": "9999999999999999.99", "-0.00": "0.00"}
    bad = ["1", "1.0", "1.000", ".99", "01.00", "+1.00", " 1.00", "NaN", "Infinity", "10000000000000000.00", "1.00\n", "-1.00", "", "１.00"]
    df = spark.createDataFrame([(x,) for x in [*good, *bad]], "raw string").select("raw", money.parse_money(F.col("raw")).alias("v"), money.parse_money(F.col("raw"), True).alias("s"))
    got = {r["raw"]: (r["v"], r["s"]) for r in df.collect()}
    assert all(got[k][0] == Decimal(v) for k, v in good.items())
    assert all(got[k][0] is None for k in bad)
    assert got["-1.00"][1] == Decimal("-1.00") and got["1"][1] is None


def test_rounding_and_fees(spark):
    d = lambda x: F.lit(x).cast("decimal(18,3)")
    assert one(spark, money.cents(d("1.005")), money.cents(d("-1.005"))) == (Decimal("1.01"), Decimal("-1.01"))
    fee = lambda m, a: money.contract_fee(F.lit(m), F.lit(a).cast("decimal(18,2)"))
    assert one(spark, fee("CARD", "0.00"), fee("CARD", "100.00"), fee("WALLET", "0.00"), fee("WALLET", "100.00"), fee("CARD", "19.99"), fee("WALLET", "64.50"), fee("CASH", "1.00")) == tuple(Decimal(x) if x else None for x in ("0.20", "2.00", "0.25", "2.25", "0.56", "1.54", None))


def test_retry_delay(spark):
    got = [money.retry_delay(F.lit(n), F.lit(30)) for n in (1, 2, 3, 7, 8, 50)]
    assert one(spark, *got) == (30, 60, 120, 1920, 3600, 3600)


def test_deadlines_through_clock_changes(spark):
    due = lambda r, d: times.deadline(F.lit(r), F.lit(d).cast("date")).cast("timestamp_ntz")
    got = one(spark, due("orders", "2026-01-10"), due("payments", "2026-07-01"), due("fees", "2026-07-01"), due("payments", "2026-03-28"), due("payments", "2026-10-24"))
    assert got == (datetime(2026, 1, 11, 0), datetime(2026, 7, 2, 0), datetime(2026, 7, 2, 10), datetime(2026, 3, 29, 1), datetime(2026, 10, 25, 0))


def test_business_days(spark):
    at = F.lit("2026-03-01 23:30:00").cast("timestamp")
    hours = lambda d: (lambda b: (F.unix_timestamp(b[1]) - F.unix_timestamp(b[0])) / 3600)(times.business_day_bounds(F.lit(d).cast("date")))
    assert one(spark, times.business_date(at), hours("2026-03-29"), hours("2026-10-25"), hours("2026-05-05")) == (date(2026, 3, 2), 23.0, 25.0, 24.0)
    a, b = F.lit("2026-01-01 00:05:00").cast("timestamp"), F.lit("2026-01-01 00:00:00").cast("timestamp")
    assert one(spark, times.delay_seconds(a, b), times.delay_seconds(b, a)) == (300, 0)


def test_dates_and_instants(spark):
    p = lambda x: times.parse_date(F.lit(x))
    assert one(spark, p("2026-09-01"), p("2026-9-1"), p("2026-02-30"), p("2026-09-01T00:00:00"), p("2026-09-01\n")) == (date(2026, 9, 1), None, None, None, None)
    i = lambda x: times.parse_instant(F.lit(x)).isNotNull()
    assert one(spark, i("2026-03-02T10:15:00+01:00"), i("2026-03-02T10:15:00Z"), i("2026-03-02T10:15:00"), i("2026-03-02T25:15:00Z"), i("yesterday")) == (True, True, False, False, False)


def test_identities(spark):
    h = F.lit("a" * 64)
    path = identity.archive_path(F.lit("payments"), F.lit("2026-03-01").cast("date"), h)
    assert one(spark, path, identity.archive_path(F.lit("payments"), F.lit("2026-03-01").cast("date"), F.lit("A" * 64))) == ("PAYMENTS/2026-03-01/aa/" + "a" * 64 + ".json", None)
    assert one(spark, identity.base_name(F.lit(r"c:\x\y.json")), identity.base_name(F.lit("/x/z.json"))) == ("y.json", "z.json")
    key = lambda f: identity.delivery_key(F.lit("shop"), F.lit("orders"), F.lit("2026-03-01").cast("date"), F.lit("ORDER"), F.lit(f), F.lit("1"), h, h)
    a, b, c = one(spark, key("in/x.json"), key("out/x.json"), key("in/y.json"))
    assert a == b != c
    assert [x[0] for x in spark.createDataFrame([("PAYMENT",), ("ORDER",), ("FEE",)], "e string").orderBy(identity.lock_rank(F.col("e"))).collect()] == ["ORDER", "FEE", "PAYMENT"]
    assert -(2**31) <= one(spark, identity.lock_number(F.lit("x")))[0] < 2**31
