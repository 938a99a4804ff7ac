"""The six datasets projected from the order and line tables of the test data.

Lines stand for payment receipts; their keys repeat with other contents, which
gives versions, duplicates and conflicts.  From the current payments follow
orders, fees, refunds, settlement lines and payouts with known faults at fixed
residues of the part key.  Everything is a function of the row, so the same
datasets can be written in SQL (``SQL``) for the oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.money import contract_fee
from .operators import canonical
from .operators.reconcile import Inputs, expected_movements
from .schemas import FILE_SCHEMA_VERSION, MONEY, PROVIDER, REPORTS


def _d(x: str | float) -> Column:
    return F.lit(x).cast(MONEY)


#: Rows of one task that settles receipts; up to ``DIRECT`` tasks a map task writes its rows out without holding them.
ROWS, MOST_ROWS, DIRECT = 200_000, 1_000_000, 200


def receipt_tasks(rows: int, cores: int) -> int:
    """Tasks that settle so many receipts: a task sorts its rows twice, and both sorts must fit its memory.

    Left to itself Spark makes tasks by compressed bytes, which are a tenth of what the sorted rows take.
    """
    return max(cores, min(-(-rows // ROWS), DIRECT), -(-rows // MOST_ROWS))


def buckets(rows: int) -> int:
    """Buckets of a table of so many receipts by identity: each is one task, which sorts its rows."""
    return max(16, -(-rows // MOST_ROWS))


def settling_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks in which the receipts of payments lie, by ``source_id``."""
    return receipt_tasks(spark.read.parquet(f"{sf_dir}/lineitem.parquet").count(), spark.sparkContext.defaultParallelism)


def bound_scan(spark: SparkSession, tasks: int) -> None:
    """Have the session read tables in so many tasks at least, as far as their row groups allow; a larger setting stays."""
    name = "spark.sql.files.minPartitionNum"
    if int(spark.conf.get(name, None) or 0) < tasks:
        spark.conf.set(name, tasks)


def _raw_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts of payments with what identifies and orders them; the rest as it stands in the lines."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    line = li.select(
        F.concat(F.lit("PAY-"), "l_orderkey", F.lit("-"), "l_linenumber").alias("source_id"), "l_orderkey",
        F.col("l_linenumber").cast("int").alias("attempt_number"), "l_partkey", "l_suppkey",
        F.col("l_extendedprice").cast(MONEY).alias("amount"), "l_returnflag", "l_linestatus",
        F.col("l_shipdate").cast("date").alias("available_on"),
        F.round(F.col("l_discount") * 100).cast("long").alias("discount_percent"),
    )
    # The only shuffle, by the identity, which a receipt id begins with: what follows needs no other.
    # Repeats go first, by the id alone; the other texts (names, hashes) are made of the rows that are left.
    receipt = F.concat_ws("|", "source_id", "l_partkey", "l_suppkey", F.col("amount").cast("string"))
    n = settling_tasks(spark, sf_dir)
    if n > DIRECT:
        # A map task now sorts its rows in memory, and a split of 128 MB has ten million of them.
        bound_scan(spark, n)
    df = line.repartition(n, "source_id").withColumn(
        "receipt_id", receipt
    ).dropDuplicates(["source_id", "receipt_id"])
    content = F.concat_ws(
        "|", "l_partkey", "l_suppkey", F.col("amount").cast("string"), "l_returnflag", "l_linestatus",
        F.col("available_on").cast("string")
    )
    twice = F.array("receipt_id", F.concat("receipt_id", F.lit("|again")))
    return df.withColumns(
        {
            "source_version": 1 + F.col("l_partkey") % 3, "source_system": F.lit(PROVIDER),
            "entity_type": F.lit("PAYMENT"), "payload_hash": F.sha2(content, 256)
        }
    ).withColumn(
        "receipt_id", F.explode(F.when(F.col("l_partkey") % 25 == 3, twice).otherwise(F.array("receipt_id")))
    )


def _payments(receipts: DataFrame) -> DataFrame:
    """The fields of payments, made of raw receipts."""
    return receipts.withColumns(
        {
            "payment_id": F.col("source_id"), "order_id": F.concat(F.lit("ORD-"), "l_orderkey"),
            "payment_method": F.when(F.col("l_returnflag") == "R", "WALLET").otherwise("CARD"),
            "status": F.when(
                (F.col("l_linestatus") == "F") & (F.col("attempt_number") <= 2), "CAPTURED"
            ).otherwise("FAILED"),
            "currency": F.lit("EUR")
        }
    ).drop("l_orderkey")


def payment_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts of payments; some are delivered a second time."""
    return _payments(_raw_receipts(spark, sf_dir))


def inputs(
    spark: SparkSession, sf_dir: str, keep: Callable[[DataFrame], DataFrame] = lambda df: df, settled: bool = True,
    ordered: bool = True, failed: bool = True
) -> Inputs:
    """Current records of the six datasets; ``keep`` is applied to what others derive from.

    Without ``settled`` that is not done to settlement lines and payouts, without ``ordered`` not to orders, for
    callers that read them once at most.  Without ``failed`` the payments are those that were captured or have a
    fee, which is all that the reconciler's rules read of them.
    """
    charged = "(status = 'CAPTURED' AND l_partkey % 10 <> 0) OR (status = 'FAILED' AND l_partkey % 200 = 0)"
    # Receipts are settled raw; the payments' texts are made of the current ones alone.
    pay = _payments(canonical.canonical(_raw_receipts(spark, sf_dir))).select(
        "payment_id", "order_id", "attempt_number", "payment_method", "status", "amount", "currency", "available_on",
        "source_version", "l_partkey", "l_returnflag", "discount_percent"
    )
    pay = keep(pay if failed else pay.where(f"status = 'CAPTURED' OR {charged}"))
    cap = pay.where("status = 'CAPTURED'")
    od = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderkey % 97 <> 0")
    taken = cap.groupBy("order_id").agg(F.sum("amount").cast(MONEY).alias("taken"))
    od = od.withColumn("order_id", F.concat(F.lit("ORD-"), "o_orderkey")).join(taken, "order_id", "left")
    status = F.when(F.col("o_orderstatus") == "F", "PAID").when(
        F.col("o_orderstatus") == "P", "CANCELLED"
    ).otherwise("PAYMENT_PENDING")
    orders = od.select(
        "order_id", status.alias("status"), F.lit("EUR").alias("currency"),
        F.when(
            (F.col("o_orderkey") % 5 == 0) | F.col("taken").isNull(), F.col("o_totalprice").cast(MONEY)
        ).otherwise(F.col("taken")).alias("order_total"),
        F.col("o_orderdate").alias("created_at_utc"), F.lit(1).cast("long").alias("source_version")
    )
    part = F.col("l_partkey")
    fee = contract_fee(F.col("payment_method"), F.col("amount"))
    reported = F.when(
        F.col("status") == "CAPTURED", (fee + F.when(part % 10 == 1, _d("1.00")).otherwise(_d("0.00"))).cast(MONEY)
    ).otherwise(_d("1.00"))
    fees = pay.where(charged).select(
        F.concat(F.lit("FEE-"), "payment_id").alias("fee_id"), "payment_id", reported.alias("amount"),
        F.lit("EUR").alias("currency"), "available_on"
    )
    back = F.when(part % 50 == 0, (F.col("amount") * F.lit("1.50").cast("decimal(3,2)")).cast(MONEY)).otherwise(
        (F.col("amount") * F.col("discount_percent").cast("decimal(3,0)") / 100).cast(MONEY)
    )
    refunds = cap.where("l_returnflag = 'A' AND discount_percent > 0").select(
        F.concat(F.lit("REF-"), "payment_id").alias("refund_id"),
        F.when(part % 40 == 7, F.lit("PAY-NONE")).otherwise(F.col("payment_id")).alias("payment_id"),
        F.lit("SUCCEEDED").alias("status"), back.alias("amount"),
        F.when(part % 31 == 4, "USD").otherwise("EUR").alias("currency"),
        F.date_add("available_on", 7).alias("available_on")
    )
    payments = pay.select(
        "payment_id", "order_id", "attempt_number", "payment_method", "status", "amount", "currency", "available_on",
        "source_version", "l_partkey"
    )
    i = Inputs(keep(orders) if ordered else orders, payments, refunds, fees, None, None)
    # A line for each movement, but for the planted faults; the part key is the payment's.
    m = expected_movements(i)
    key = F.regexp_extract("movement_id", r"PAY-\d+-\d+", 0)
    m = m.withColumn("payment_id", key).join(pay.select("payment_id", "l_partkey"), "payment_id").where(
        "l_partkey % 60 <> 3 AND NOT startswith(movement_id, 'expected-fee:')"
    )
    amount = (F.col("signed_amount") + F.when(part % 60 == 4, _d("0.01")).otherwise(_d("0.00"))).cast(MONEY)
    one = m.select(
        F.concat_ws("-", F.lit("LINE"), "movement_type", "movement_id").alias("settlement_line_id"),
        F.concat(F.lit("OUT-"), F.col("available_on").cast("string")).alias("payout_id"), "movement_type",
        "movement_id", amount.alias("signed_amount"), "available_on", "l_partkey"
    )
    again = F.array("settlement_line_id", F.concat("settlement_line_id", F.lit("-2")))
    lines = one.withColumn(
        "settlement_line_id", F.explode(F.when(part % 60 == 5, again).otherwise(F.array("settlement_line_id")))
    )
    later = keep if settled else lambda df: df
    lines = later(lines)
    net = lines.groupBy(
        "payout_id", F.col("available_on").alias("payout_date")
    ).agg(F.sum("signed_amount").cast(MONEY).alias("net"))
    payouts = net.where("net >= 0").select(
        "payout_id", "payout_date", F.lit("EUR").alias("currency"),
        (
            F.col("net") + F.when(F.dayofyear("payout_date") % 9 == 0, _d("1.00")).otherwise(_d("0.00"))
        ).cast(MONEY).alias("reported_net_amount")
    )
    i.lines, i.payouts = lines.drop("available_on", "l_partkey"), later(payouts)
    return i


def deliveries(spark: SparkSession, sf_dir: str, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The datasets as daily deliveries, in the shape that the gate reads: data file and manifest of each report and day."""
    i = inputs(spark, sf_dir, keep)
    at, version, day = F.lit(
        "2020-01-01T00:00:00Z"
    ).alias("effective_at_utc"), F.lit(1).alias("source_version"), lambda c: F.date_format(c, "yyyy-MM-dd")
    money = lambda c: F.col(c).cast("string").alias(c)
    rows = {
        "orders": (
            i.orders, day("created_at_utc"),
            [
                "order_id", F.lit("2020-01-01T00:00:00Z").alias("created_at_utc"), "status", "currency",
                money("order_total"), version
            ]
        ),
        "payments": (
            i.payments, day("available_on"),
            [
                "payment_id", "order_id", "attempt_number", "payment_method", "status", money("amount"), "currency", at,
                F.when(F.col("status") == "CAPTURED", day("available_on")).alias("available_on"), "source_version"
            ]
        ),
        "refunds": (
            i.refunds, day("available_on"),
            [
                "refund_id", "payment_id", "status", money("amount"), "currency", at,
                day("available_on").alias("available_on"), version
            ]
        ),
        "fees": (
            i.fees, day("available_on"),
            [
                "fee_id", "payment_id", F.lit("PROCESSING").alias("fee_type"), money("amount"), "currency", at,
                day("available_on").alias("available_on"), version
            ]
        ),
        "settlement_lines": (
            i.lines, F.replace("payout_id", F.lit("OUT-"), F.lit("")),
            [
                "settlement_line_id", "payout_id", "movement_type", "movement_id", money("signed_amount"),
                F.lit("EUR").alias("currency"), version
            ]
        ),
        "payouts": (
            i.payouts, day("payout_date"),
            ["payout_id", day("payout_date").alias("payout_date"), "currency", money("reported_net_amount"), version]
        ),
    }
    out = []
    for report, (df, date, columns) in rows.items():
        entity, system, _ = REPORTS[report]
        one = df.select(
            date.alias("report_date"), F.to_json(F.struct(*columns)).alias("row")
        ).groupBy("report_date").agg(F.sort_array(F.collect_list("row")).alias("rows"))
        stem = F.concat(F.lit(f"{report}-"), F.col("report_date"))
        one = one.select(
            stem.alias("stem"), "report_date", F.size("rows").alias("n"),
            F.encode(F.concat(F.lit("["), F.array_join("rows", ","), F.lit("]")), "utf-8").alias("data_bytes")
        )
        said = {
            "filename": F.concat("stem", F.lit(".json")), "source_system": F.lit(system), "report_type": F.lit(report),
            "report_date": F.col("report_date"), "entity_type": F.lit(entity),
            "schema_version": F.lit(FILE_SCHEMA_VERSION), "row_count": F.col("n"),
            "checksum_sha256": F.sha2("data_bytes", 256)
        }
        out.append(
            one.select(
                "stem", "data_bytes",
                F.encode(F.to_json(F.struct(*[c.alias(k) for k, c in said.items()])), "utf-8").alias("manifest_bytes"),
                F.lit(False).alias("writing")
            )
        )
    return reduce(DataFrame.unionByName, out)


#: The same datasets in SQL; names as in ``inputs``.
SQL = """
receipts0 AS (SELECT DISTINCT ON (receipt_id) * FROM (SELECT 'PAY-' || l_orderkey || '-' || l_linenumber AS payment_id, 'ORD-' || l_orderkey AS order_id, l_linenumber AS attempt_number,
  CASE WHEN l_returnflag = 'R' THEN 'WALLET' ELSE 'CARD' END AS payment_method, CASE WHEN l_linestatus = 'F' AND l_linenumber <= 2 THEN 'CAPTURED' ELSE 'FAILED' END AS status,
  l_extendedprice::DECIMAL(18,2) AS amount, l_shipdate::DATE AS available_on, 1 + l_partkey % 3 AS source_version, l_partkey, l_returnflag, round(l_discount * 100)::BIGINT AS pct,
  concat_ws('|', 'PAY-' || l_orderkey || '-' || l_linenumber, l_partkey, l_suppkey, l_extendedprice::DECIMAL(18,2)) AS receipt_id,
  sha256(concat_ws('|', l_partkey, l_suppkey, l_extendedprice::DECIMAL(18,2), l_returnflag, l_linestatus, l_shipdate::DATE)) AS payload_hash FROM lineitem)),
receipts AS MATERIALIZED (SELECT * FROM receipts0 UNION ALL SELECT * REPLACE (receipt_id || '|again' AS receipt_id) FROM receipts0 WHERE l_partkey % 25 = 3),
tops AS (SELECT payment_id, max(source_version) AS top FROM receipts GROUP BY payment_id),
heads AS (SELECT r.payment_id, t.top, count(DISTINCT r.payload_hash) AS hashes FROM receipts r JOIN tops t ON r.payment_id = t.payment_id AND r.source_version = t.top GROUP BY r.payment_id, t.top),
ev AS MATERIALIZED (SELECT r.*, CASE WHEN source_version < top THEN 'STALE' WHEN hashes > 1 THEN 'CONFLICTED'
  WHEN receipt_id = min(receipt_id) OVER (PARTITION BY r.payment_id, source_version, payload_hash) THEN 'ACCEPTED' ELSE 'DUPLICATE' END AS disposition FROM receipts r JOIN heads h ON r.payment_id = h.payment_id),
pay AS MATERIALIZED (SELECT * FROM ev WHERE disposition = 'ACCEPTED'),
cap AS MATERIALIZED (SELECT *, CASE payment_method WHEN 'CARD' THEN round(0.20 + amount * 0.018, 2) ELSE round(0.25 + amount * 0.020, 2) END::DECIMAL(18,2) AS fee FROM pay WHERE status = 'CAPTURED'),
ord AS MATERIALIZED (SELECT 'ORD-' || o_orderkey AS order_id, CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'P' THEN 'CANCELLED' ELSE 'PAYMENT_PENDING' END AS status,
  CASE WHEN o_orderkey % 5 = 0 OR taken IS NULL THEN o_totalprice::DECIMAL(18,2) ELSE taken END::DECIMAL(18,2) AS order_total
  FROM orders LEFT JOIN (SELECT order_id AS k, sum(amount) AS taken FROM cap GROUP BY order_id) ON k = 'ORD-' || o_orderkey WHERE o_orderkey % 97 <> 0),
fee AS MATERIALIZED (SELECT 'FEE-' || payment_id AS fee_id, payment_id, (fee + CASE WHEN l_partkey % 10 = 1 THEN 1.00 ELSE 0.00 END)::DECIMAL(18,2) AS amount FROM cap WHERE l_partkey % 10 <> 0
  UNION ALL SELECT 'FEE-' || payment_id, payment_id, 1.00::DECIMAL(18,2) FROM pay WHERE status = 'FAILED' AND l_partkey % 200 = 0),
ref AS MATERIALIZED (SELECT 'REF-' || payment_id AS refund_id, CASE WHEN l_partkey % 40 = 7 THEN 'PAY-NONE' ELSE payment_id END AS payment_id,
  CASE WHEN l_partkey % 50 = 0 THEN round(amount * 1.50, 2) ELSE round(amount * pct::DECIMAL(3,0) * 0.01, 2) END::DECIMAL(18,2) AS amount, (available_on + 7)::DATE AS available_on, l_partkey, CASE WHEN l_partkey % 31 = 4 THEN 'USD' ELSE 'EUR' END AS currency
  FROM cap WHERE l_returnflag = 'A' AND pct > 0),
capfee AS MATERIALIZED (SELECT cap.*, f.fee_total, coalesce(f.n, 0) AS n_fees, f.fee_id FROM cap LEFT JOIN (SELECT payment_id AS k, sum(amount)::DECIMAL(18,2) AS fee_total, count(*) AS n, min(fee_id) AS fee_id FROM fee GROUP BY 1) f ON f.k = cap.payment_id),
mov AS MATERIALIZED (SELECT 'CAPTURE' AS movement_type, payment_id AS movement_id, available_on, amount AS signed_amount, l_partkey FROM cap
  UNION ALL SELECT 'FEE', CASE WHEN n_fees = 1 THEN fee_id ELSE 'expected-fee:' || payment_id END, available_on, -fee, l_partkey FROM capfee
  UNION ALL SELECT 'REFUND', refund_id, available_on, -amount, l_partkey FROM ref),
line AS MATERIALIZED (SELECT 'LINE-' || movement_type || '-' || movement_id || s AS settlement_line_id, 'OUT-' || available_on AS payout_id, movement_type, movement_id,
  (signed_amount + CASE WHEN l_partkey % 60 = 4 THEN 0.01 ELSE 0.00 END)::DECIMAL(18,2) AS signed_amount, available_on
  FROM mov JOIN (VALUES (''), ('-2')) v(s) ON s = '' OR l_partkey % 60 = 5 WHERE l_partkey % 60 <> 3 AND NOT starts_with(movement_id, 'expected-fee:')),
out AS MATERIALIZED (SELECT payout_id, payout_date, (net + CASE WHEN dayofyear(payout_date) % 9 = 0 THEN 1.00 ELSE 0.00 END)::DECIMAL(18,2) AS reported_net_amount
  FROM (SELECT payout_id, available_on AS payout_date, sum(signed_amount) AS net FROM line GROUP BY 1, 2) WHERE net >= 0)"""
