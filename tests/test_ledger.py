"""Rows are counted while the ledger writes them: a lost one stops the batch."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from settleforge.sources import ledger as module
from settleforge.sources.ledger import Ledger, RowsLost


def found(spark, n=4):
    rows = [f'{{"fee_id": "f{k}", "payment_id": "p", "fee_type": "PROCESSING", "amount": "{"1.00" if k else "x"}", "currency": "EUR", "effective_at_utc": "2026-03-02T00:00:00Z", "available_on": "2026-03-02", "source_version": 1}}' for k in range(n)]
    df = spark.createDataFrame([("a" * 64, "fees.json", "provider", "fees", rows)], "delivery_key string, filename string, source_system string, report_type string, rows array<string>")
    return df.select(
        "delivery_key", "filename", "source_system", "report_type", F.lit("2026-03-02").cast("date").alias("report_date"), F.lit("1").alias("schema_version"),
        F.lit("c").alias("checksum_sha256"), F.lit("m").alias("manifest_checksum"), F.lit(n).cast("long").alias("declared_row_count"),
        F.lit(b"x").alias("data_bytes"), F.lit(b"y").alias("manifest_bytes"), "rows"
    )


@pytest.mark.parametrize("which", ["receipt", "quarantined row", None])
def test_lost_rows(spark, tmp_path, monkeypatch, which):
    real = module.split

    def leaky(df, entity):
        good, bad = real(df, entity)
        keep = F.col("row_number") != 1
        return (good.where(keep) if which == "receipt" else good), (bad.limit(0) if which == "quarantined row" else bad)

    monkeypatch.setattr(module, "split", leaky)
    ledger = Ledger(spark, "file://" + str(tmp_path))
    if which is None:
        assert ledger.ingest(found(spark), datetime(2026, 3, 3)) == 1
    else:
        with pytest.raises(RowsLost, match="4 rows came in, 3 were stored"):
            ledger.ingest(found(spark), datetime(2026, 3, 3))
        assert ledger.batches().isEmpty() and ledger.receipts("FEE").isEmpty() and ledger.quarantine().isEmpty()
        monkeypatch.setattr(module, "split", real)
        assert ledger.ingest(found(spark), datetime(2026, 3, 4)) == 1
    assert (ledger.receipts("FEE").count(), ledger.quarantine().count()) == (3, 1)


def test_bucketed_receipts_are_settled_in_place(spark, tmp_path):
    import random

    from settleforge.operators import canonical
    from settleforge.sources.bucketed import BucketedReceipts

    r = random.Random(2)
    rows = [(f"r{k}", "provider", r.choice(["FEE", "PAYMENT"]), f"e{r.randrange(20)}", r.randrange(1, 4), r.choice("ab")) for k in range(120)]
    df = spark.createDataFrame(rows, "receipt_id string, source_system string, entity_type string, source_id string, source_version long, payload_hash string")
    path = "file://" + str(tmp_path / "receipts")
    table = BucketedReceipts(spark, path, df.schema, 8)
    table.append(df.limit(80))
    table.append(df)
    got, want = table.evidence(), canonical.evidence(df)
    assert sorted(map(tuple, got.select("receipt_id", "disposition").collect())) == sorted(map(tuple, want.select("receipt_id", "disposition").collect()))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    table.forget()
    again = BucketedReceipts(spark, path, df.schema, 8)
    assert again.read().count() == 200 and again.unique().count() == 120
    again.forget()
    assert any((tmp_path / "receipts").iterdir())


def test_receipts_that_lie_in_buckets_are_not_shuffled(spark, tmp_path):
    """Rows that lie by the bucket's columns go into its files as they are; tasks and buckets follow the rows."""
    from settleforge import fixtures
    from settleforge.operators import canonical
    from settleforge.sources.bucketed import BucketedReceipts

    names = ["receipt_id", *canonical.IDENTITY, "source_version", "payload_hash"]
    r = fixtures.payment_receipts(spark, "/root/testdata/sf0.001").select(*names)
    n, plan = fixtures.settling_tasks(spark, "/root/testdata/sf0.001"), lambda df: df._jdf.queryExecution().executedPlan().toString()
    table = BucketedReceipts(spark, "file://" + str(tmp_path / "t"), r.schema, 2 * n, ("source_id",))
    for _ in range(2):
        table.append(r, placed=True)
    files = [p.name for p in (tmp_path / "t").glob("part-*.parquet")]
    assert n < len(files) <= 2 * 2 * n
    out = table.evidence()
    assert "Exchange" not in plan(out) and out.rdd.getNumPartitions() == 2 * n
    pick = lambda df: sorted(df.select("receipt_id", "disposition").collect())
    assert pick(out) == pick(canonical.evidence(r))
    table.forget()


def test_a_delivery_is_parsed_once_and_a_receipt_is_shuffled_once(spark, tmp_path):
    """Conditions on findings do not repeat the parsing, and current records and conflicts come out of one shuffle by identity."""
    from settleforge.sources import deliveries

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    raw = spark.createDataFrame([("x/a", b"[]", b"{}", False)] * 2, "stem string, data_bytes binary, manifest_bytes binary, writing boolean").repartition(2)
    sound = plan(deliveries.judged(deliveries.gate(raw)).where("fault IS NULL AND delivery_key IS NOT NULL"))
    assert sound.count("parseJson") == 2 and sound.count("ArrayType(VariantType") == 1
    ledger = Ledger(spark, "file://" + str(tmp_path))
    assert ledger.ingest(found(spark), datetime(2026, 3, 3)) == 1
    one = plan(ledger.evidence()["FEE"])
    assert one.count("hashpartitioning(source_system") == 1 and "hashpartitioning(receipt_id" not in one
    assert ledger.current()["FEE"].count() == ledger.evidence()["FEE"].where("disposition = 'ACCEPTED'").count() > 0
