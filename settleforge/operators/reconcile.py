"""The reconciler: orders against collections, payouts against movements, and every exception between them.

Inputs are frames of current records, one per entity, and completeness results.
Every rule is a frame of its own in one common shape; a rule that may only run
when certain reports are complete is joined to a one-row gate, so the plan stays
lazy.  All joins are on payment, order or payout ids or on the payout date, after
aggregating the many side, so no rule compares rows pairwise.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import contract_fee, total, variance
from ..plans.checkpoints import saved
from ..schemas import CONTRACT_VERSION, MONEY, PAYOUT_REPORTS, PROVIDER, REPORTS, RULE_OF, SHOP, TRANSACTION_REPORTS
from .completeness import completeness_exceptions


class ReconciliationError(ValueError):
    """The inputs cannot be reconciled at all."""


@dataclass
class Inputs:
    """Current records by entity; ``completeness`` has a row for each of the six reports.

    Frames that several rules read are made once by ``shared``; ``keep`` says what
    becomes of them (``saved`` writes them, which pays when many rules run).
    """

    orders: DataFrame
    payments: DataFrame
    refunds: DataFrame
    fees: DataFrame
    lines: DataFrame
    payouts: DataFrame
    completeness: DataFrame | None = None
    conflicts: DataFrame | None = None
    quarantine: DataFrame | None = None
    keep: Callable[[DataFrame], DataFrame] = lambda df: df
    made: dict[str, DataFrame] = field(default_factory=dict)

    def shared(self, build: Callable[[Inputs], DataFrame]) -> DataFrame:
        """The frame that ``build`` makes of these inputs, made once."""
        if build.__name__ not in self.made:
            self.made[build.__name__] = self.keep(build(self))
        return self.made[build.__name__]


@dataclass
class Result:
    transactions: DataFrame
    payouts: DataFrame
    movements: DataFrame
    exceptions: DataFrame
    completeness: DataFrame | None
    quarantine: DataFrame | None
    detected_at: object = None
    input_fingerprint: str | None = None


def ref(entity: str, id_col: str) -> Column:
    """How an exception or movement names a supporting record."""
    system = SHOP if entity == "ORDER" else PROVIDER
    return F.concat(F.lit(f"{system}:{entity}:"), F.col(id_col))


def exception(
    df: DataFrame, code: str, entity_type: str | Column, entity_id: Column, expected=None, actual=None,
    supports: Column | None = None, order: Column | None = None, payout: Column | None = None,
    rank: Column | None = None
) -> DataFrame:
    """A rule's rows in the common shape; ``order`` and ``payout`` say which result carries the code."""
    money = lambda x: F.lit(None).cast(MONEY) if x is None else (
        x if isinstance(x, Column) else F.lit(x)
    ).cast(MONEY)
    text = lambda x: F.lit(None).cast("string") if x is None else x
    return df.select(
        F.lit(RULE_OF[code]).alias("rule_id"),
        F.lit(code).alias("exception_type"),
        (entity_type if isinstance(entity_type, Column) else F.lit(entity_type)).alias("entity_type"),
        entity_id.alias("entity_id"),
        money(expected).alias("expected_amount"),
        money(actual).alias("actual_amount"),
        variance(money(expected), money(actual)).alias("variance"),
        (
            F.array_sort(F.array_distinct(supports)) if supports is not None else F.array().cast("array<string>")
        ).alias("supporting_source_record_ids"),
        text(order).alias("order_id"),
        text(payout).alias("payout_id"),
        text(rank).alias("emitted"),
    )


def captured(payments: DataFrame) -> DataFrame:
    return payments.where("status = 'CAPTURED'")


def succeeded(refunds: DataFrame) -> DataFrame:
    return refunds.where("status = 'SUCCEEDED'")


# --- rules on payments, refunds and fees ---------------------------------------------------------


def orphan_payments(i: Inputs) -> DataFrame:
    """Captures whose order is unknown."""
    df = i.shared(capture_facts).where("order_status IS NULL")
    return exception(
        df, "ORPHAN_PAYMENT", "PAYMENT", F.col("payment_id"), None, F.col("amount"),
        F.array(ref("PAYMENT", "payment_id"))
    )


def captures_on_cancelled(i: Inputs) -> DataFrame:
    """Captures of cancelled orders; of several on one order the largest payment id stands for all."""
    df = i.shared(capture_facts).where("order_status = 'CANCELLED'")
    return exception(
        df, "CAPTURE_FOR_NON_PAYABLE_ORDER", "ORDER", F.col("order_id"), "0.00", F.col("amount"),
        F.array(ref("ORDER", "order_id"), ref("PAYMENT", "payment_id")), order=F.col("order_id"),
        rank=F.col("payment_id")
    )


def orphan_refunds(i: Inputs) -> DataFrame:
    """Succeeded refunds of no captured payment."""
    df = succeeded(i.refunds).join(captured(i.payments).select("payment_id"), "payment_id", "left_anti")
    return exception(
        df, "ORPHAN_REFUND", "REFUND", F.col("refund_id"), None, F.col("amount"), F.array(ref("REFUND", "refund_id"))
    )


def refund_currency(i: Inputs) -> DataFrame:
    """Refunds in another currency than their payment."""
    p = captured(i.payments).select("payment_id", "order_id", F.col("currency").alias("_c"))
    df = succeeded(i.refunds).join(p, "payment_id").where("currency <> _c")
    return exception(
        df, "REFUND_CURRENCY_MISMATCH", "REFUND", F.col("refund_id"),
        supports=F.array(ref("PAYMENT", "payment_id"), ref("REFUND", "refund_id")), order=F.col("order_id")
    )


def refund_totals(i: Inputs) -> DataFrame:
    """Refund total, count and references by payment."""
    return succeeded(i.refunds).groupBy("payment_id").agg(
        total("amount").alias("refund_total"), F.count(F.lit(1)).alias("refund_count"),
        F.collect_set(ref("REFUND", "refund_id")).alias("refund_refs")
    )


def excess_refunds(i: Inputs) -> DataFrame:
    """Payments refunded beyond their amount."""
    df = i.shared(capture_facts).where("refund_total > amount")
    return exception(
        df, "EXCESS_REFUND", "PAYMENT", F.col("payment_id"), F.col("amount"), F.col("refund_total"),
        F.concat(F.array(ref("PAYMENT", "payment_id")), F.col("refund_refs")), order=F.col("order_id")
    )


def payment_fees(i: Inputs) -> DataFrame:
    """Captures with their contractual fee and what fees are reported: total, count, ids in order."""
    f = i.fees.groupBy("payment_id").agg(
        total("amount").alias("fee_total"), F.count(F.lit(1)).alias("fee_count"),
        F.array_sort(F.collect_set("fee_id")).alias("fee_ids")
    )
    df = captured(i.payments).join(f, "payment_id", "left")
    none = {"fee_count": F.lit(0), "fee_total": F.lit(0).cast(MONEY), "fee_ids": F.array().cast("array<string>")}
    df = df.withColumns({c: F.coalesce(c, x) for c, x in none.items()})
    return df.withColumn("expected_fee", contract_fee(F.col("payment_method"), F.col("amount")))


def capture_facts(i: Inputs) -> DataFrame:
    """Captures with their fees, their succeeded refunds and their order's status (null: no such order); all rules on payments are filters of it."""
    o = i.orders.select("order_id", F.col("status").alias("order_status"))
    columns = (
        "payment_id", "order_id", "amount", "currency", "available_on", "expected_fee", "fee_total", "fee_count",
        "fee_ids", "refund_total", "refund_count", "refund_refs", "order_status"
    )
    return payment_fees(i).join(refund_totals(i), "payment_id", "left").join(o, "order_id", "left").select(*columns)


def _fees(i: Inputs) -> DataFrame:
    """Captures with their fees: the shared facts where they are made, else no more than is asked for."""
    return i.made[capture_facts.__name__] if capture_facts.__name__ in i.made else payment_fees(i)


def _fee_refs() -> Column:
    return F.transform("fee_ids", lambda x: F.concat(F.lit(f"{PROVIDER}:FEE:"), x))


def missing_fees(i: Inputs) -> DataFrame:
    df = _fees(i).where("fee_count = 0")
    return exception(
        df, "MISSING_FEE", "PAYMENT", F.col("payment_id"), F.col("expected_fee"), "0.00",
        F.array(ref("PAYMENT", "payment_id")), order=F.col("order_id")
    )


def fee_mismatches(i: Inputs) -> DataFrame:
    df = _fees(i).where("fee_count > 0 AND fee_total <> expected_fee")
    return exception(
        df, "FEE_MISMATCH", "PAYMENT", F.col("payment_id"), F.col("expected_fee"), F.col("fee_total"),
        F.concat(F.array(ref("PAYMENT", "payment_id")), _fee_refs()), order=F.col("order_id")
    )


def unexpected_fees(i: Inputs) -> DataFrame:
    df = i.fees.join(captured(i.payments).select("payment_id"), "payment_id", "left_anti")
    return exception(
        df, "UNEXPECTED_FEE", "FEE", F.col("fee_id"), "0.00", F.col("amount"), F.array(ref("FEE", "fee_id"))
    )


# --- orders --------------------------------------------------------------------------------------


def order_totals(i: Inputs) -> DataFrame:
    """Each order with what its captures, refunds and fees add up to; refunds and fees only of its captures."""
    by_order = i.shared(capture_facts).groupBy("order_id").agg(
        total("amount").alias("captured_total"), F.count(F.lit(1)).alias("captured_payment_count"),
        total("refund_total").alias("successful_refund_total"),
        F.coalesce(F.sum("refund_count"), F.lit(0)).alias("successful_refund_count"),
        total("expected_fee").alias("expected_fee_total"), total("fee_total").alias("reported_fee_total"),
        F.collect_set(ref("PAYMENT", "payment_id")).alias("payment_refs")
    )
    df = i.orders.join(by_order, "order_id", "left")
    zero = F.lit(0).cast(MONEY)
    df = df.withColumns(
        {
            c: F.coalesce(c, zero) for c in (
                "captured_total", "successful_refund_total", "expected_fee_total", "reported_fee_total"
            )
        } | {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("captured_payment_count", "successful_refund_count")} | {"payment_refs": F.coalesce("payment_refs", F.array().cast("array<string>"))}
    )
    return df.withColumn(
        "expected_collection", F.when(F.col("status") == "PAID", F.col("order_total")).otherwise(zero).cast(MONEY)
    )


def _order_supports() -> Column:
    return F.concat(F.array(ref("ORDER", "order_id")), F.col("payment_refs"))


def missing_payments(i: Inputs) -> DataFrame:
    df = i.shared(order_totals).where("status = 'PAID' AND captured_payment_count = 0")
    return exception(
        df, "MISSING_PAYMENT", "ORDER", F.col("order_id"), F.col("order_total"), "0.00",
        F.array(ref("ORDER", "order_id")), order=F.col("order_id")
    )


def payment_mismatches(i: Inputs) -> DataFrame:
    df = i.shared(order_totals).where(
        "status = 'PAID' AND captured_payment_count > 0 AND captured_total <> order_total"
    )
    return exception(
        df, "PAYMENT_AMOUNT_MISMATCH", "ORDER", F.col("order_id"), F.col("order_total"), F.col("captured_total"),
        _order_supports(), order=F.col("order_id")
    )


def multiple_captures(i: Inputs) -> DataFrame:
    df = i.shared(order_totals).where("status = 'PAID' AND captured_payment_count > 1")
    return exception(
        df, "MULTIPLE_CAPTURE", "ORDER", F.col("order_id"), "1.00", F.col("captured_payment_count"), _order_supports(),
        order=F.col("order_id")
    )


# --- movements and payouts -----------------------------------------------------------------------


def expected_movements(i: Inputs) -> DataFrame:
    """What must be paid out: each capture, its contractual fee, each succeeded refund.

    A fee's movement has the reported fee's id only if there is exactly one.
    """
    p = _fees(i)
    pay = F.array(ref("PAYMENT", "payment_id"))
    fee_id = F.when(F.col("fee_count") == 1, F.col("fee_ids")[0]).otherwise(
        F.concat(F.lit("expected-fee:"), F.col("payment_id"))
    )
    capture = p.select(
        F.lit("CAPTURE").alias("movement_type"), F.col("payment_id").alias("movement_id"), "available_on",
        F.col("amount").alias("signed_amount"), pay.alias("supporting_source_record_ids")
    )
    fee = p.select(
        F.lit("FEE").alias("movement_type"), fee_id.alias("movement_id"), "available_on",
        (-F.col("expected_fee")).cast(MONEY).alias("signed_amount"),
        F.concat(pay, _fee_refs()).alias("supporting_source_record_ids")
    )
    refund = succeeded(i.refunds).select(
        F.lit("REFUND").alias("movement_type"), F.col("refund_id").alias("movement_id"), "available_on",
        (-F.col("amount")).cast(MONEY).alias("signed_amount"),
        F.array(ref("REFUND", "refund_id")).alias("supporting_source_record_ids")
    )
    return capture.unionByName(fee).unionByName(refund)


def duplicate_settlement(i: Inputs) -> DataFrame:
    """Movements with several settlement lines; a row for each payout that has one of them, alike but for the payout."""
    key = ["movement_type", "movement_id"]
    many = i.lines.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.collect_set(ref("SETTLEMENT_LINE", "settlement_line_id")).alias("refs"),
        F.collect_set("payout_id").alias("payout_ids")
    ).where("n > 1")
    df = many.withColumn("payout_id", F.explode("payout_ids"))
    return exception(
        df, "DUPLICATE_SETTLEMENT_MOVEMENT", "SETTLEMENT_MOVEMENT", F.concat_ws(":", *key), None, F.col("n"),
        F.col("refs"), payout=F.col("payout_id")
    )


def settled_movements(i: Inputs) -> DataFrame:
    """Each movement of a payout's day with the payout's own lines for it: count, amount, ids."""
    m = expected_movements(i).join(
        i.payouts.select("payout_id", F.col("payout_date").alias("available_on")), "available_on"
    )
    l = i.lines.groupBy("payout_id", "movement_type", "movement_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.min("signed_amount").alias("line_amount"),
        F.min("settlement_line_id").alias("line_id")
    )  # noqa: E741
    return m.join(
        l, ["payout_id", "movement_type", "movement_id"], "left"
    ).withColumn("n_lines", F.coalesce("n_lines", F.lit(0)))


def missing_settlement_lines(i: Inputs) -> DataFrame:
    df = i.shared(settled_movements).where("n_lines = 0")
    return exception(
        df, "MISSING_SETTLEMENT_LINE", "EXPECTED_MOVEMENT", F.concat_ws(":", "movement_type", "movement_id"),
        F.col("signed_amount"), "0.00", F.col("supporting_source_record_ids"), payout=F.col("payout_id")
    )


def line_amount_mismatches(i: Inputs) -> DataFrame:
    """Single lines that differ from their movement; a fee's line is held against the reported fee if there is one."""
    f = i.fees.select(
        F.col("fee_id").alias("movement_id"), F.lit("FEE").alias("movement_type"), F.col("amount").alias("fee_amount")
    )
    df = i.shared(settled_movements).where("n_lines = 1").join(f, ["movement_type", "movement_id"], "left")
    df = df.withColumn(
        "expected", F.coalesce(-F.col("fee_amount"), F.col("signed_amount")).cast(MONEY)
    ).where("line_amount <> expected")
    return exception(
        df, "SETTLEMENT_LINE_AMOUNT_MISMATCH", "SETTLEMENT_LINE", F.col("line_id"), F.col("expected"),
        F.col("line_amount"),
        F.concat(F.col("supporting_source_record_ids"), F.array(ref("SETTLEMENT_LINE", "line_id"))),
        payout=F.col("payout_id")
    )


def payout_totals(i: Inputs) -> DataFrame:
    """Each payout with its lines' total and its day's expected movements."""
    l = i.lines.groupBy("payout_id").agg(
        total("signed_amount").alias("reported_line_total"), F.count(F.lit(1)).alias("settlement_line_count")
    )  # noqa: E741
    m = expected_movements(i).groupBy(F.col("available_on").alias("payout_date")).agg(
        total("signed_amount").alias("expected_payout"), F.count(F.lit(1)).alias("expected_movement_count")
    )
    df = i.payouts.join(l, "payout_id", "left").join(m, "payout_date", "left")
    zero = F.lit(0).cast(MONEY)
    df = df.withColumns(
        {c: F.coalesce(c, zero) for c in ("reported_line_total", "expected_payout")} | {
            c: F.coalesce(c, F.lit(0)) for c in ("settlement_line_count", "expected_movement_count")
        }
    )
    return df.withColumns(
        {
            "provider_report_variance": variance(F.col("reported_line_total"), F.col("reported_net_amount")),
            "end_to_end_payout_variance": variance(F.col("expected_payout"), F.col("reported_net_amount"))
        }
    )


def payout_total_mismatches(i: Inputs) -> DataFrame:
    """Payouts whose reported amount is not their lines' total; the lines of these alone are gathered as supports."""
    off = i.shared(payout_totals).where("provider_report_variance <> 0")
    refs = i.lines.join(off.select("payout_id"), "payout_id", "left_semi").groupBy("payout_id").agg(
        F.collect_set(ref("SETTLEMENT_LINE", "settlement_line_id")).alias("line_refs")
    )
    df = off.join(refs, "payout_id", "left").withColumn(
        "line_refs", F.coalesce("line_refs", F.array().cast("array<string>"))
    )
    return exception(
        df, "PAYOUT_TOTAL_MISMATCH", "PAYOUT", F.col("payout_id"), F.col("reported_line_total"),
        F.col("reported_net_amount"), F.concat(F.array(ref("PAYOUT", "payout_id")), F.col("line_refs")),
        payout=F.col("payout_id")
    )


def mismatch_supports(i: Inputs) -> DataFrame:
    """(payout_id, ordinal, support) of payouts with another total than their lines: a row a support, for payouts of any size.

    Ordinals follow the published order of supports.  Lines are numbered by ranges
    of their ids, counted first and then numbered inside, so no task sorts all lines
    of a payout.
    """
    off = i.shared(payout_totals).where("provider_report_variance <> 0").select("payout_id")
    mine = i.lines.join(off, "payout_id", "left_semi").select(
        "payout_id", ref("SETTLEMENT_LINE", "settlement_line_id").alias("support")
    )
    rows = off.select("payout_id", ref("PAYOUT", "payout_id").alias("support")).unionByName(mine).distinct()
    # The cuts are quantiles of the supports as they are, so the ranges are about even.
    rows = rows.repartitionByRange("payout_id", "support").sortWithinPartitions("payout_id", "support")
    rows = saved(rows.withColumn("_r", F.spark_partition_id()))  # written, so that the ranges stay what they are
    n = rows.groupBy("payout_id", "_r").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("payout_id").orderBy("_r")) - F.col("n")
    start = n.select("payout_id", "_r", before.alias("start"))
    inside = F.row_number().over(Window.partitionBy("payout_id", "_r").orderBy("support"))
    return rows.withColumn("k", inside).join(start, ["payout_id", "_r"]).select(
        "payout_id", (F.col("start") + F.col("k")).alias("ordinal"), "support"
    )


def conflict_exceptions(conflicts: DataFrame) -> DataFrame:
    """Entities in conflict; the exception's entity type is the conflict's own."""
    c = conflicts.withColumn("_type", F.col("entity_type"))
    return exception(c, "CONFLICTING_SOURCE_VERSION", F.col("_type"), F.col("source_id"), supports=F.col("receipt_ids"))


def batch_conflicts(batches: DataFrame) -> DataFrame:
    """Batches of one source, report and id with several checksums; an extra query that no result needs."""
    return batches.groupBy("source_system", "report_type", "batch_id").agg(
        F.count_distinct("file_checksum").alias("n")
    ).where("n > 1")


#: Rule, reports that must be complete before it runs, and the result that carries its code.
RULES = (
    (orphan_payments, ("orders", "payments"), None),
    (captures_on_cancelled, ("orders", "payments"), "order"),
    (orphan_refunds, ("payments", "refunds"), None),
    (refund_currency, ("payments", "refunds"), "order"),
    (excess_refunds, ("payments", "refunds"), "order"),
    (missing_fees, ("payments", "fees"), "order"),
    (fee_mismatches, ("payments", "fees"), "order"),
    (unexpected_fees, ("payments", "fees"), None),
    (missing_payments, ("orders", "payments"), "order"),
    (payment_mismatches, ("orders", "payments"), "order"),
    (multiple_captures, ("orders", "payments"), "order"),
    (duplicate_settlement, ("settlement_lines",), "payout"),
    (missing_settlement_lines, ("payments", "refunds", "fees", "settlement_lines"), "payout"),
    (line_amount_mismatches, ("payments", "refunds", "fees", "settlement_lines"), "payout"),
    (payout_total_mismatches, ("settlement_lines", "payouts"), "payout"),
)


def _states(completeness: DataFrame) -> DataFrame:
    """One row: report type -> state."""
    return completeness.agg(F.map_from_entries(F.collect_list(F.struct("report_type", "state"))).alias("_states"))


def _gated(df: DataFrame, states: DataFrame | None, reports: tuple[str, ...]) -> DataFrame:
    if states is None:
        return df
    ready = reduce(lambda a, b: a & b, [F.col("_states")[r] == "COMPLETE" for r in reports])
    return df.join(F.broadcast(states.where(ready).select(F.lit(1).alias("_go")))).drop("_go")


def _rule_rows(i: Inputs, carried_by: tuple[str | None, ...]) -> list[DataFrame]:
    """Rows of the rules that may run and whose codes those results carry."""
    states = None if i.completeness is None else _states(i.completeness)
    return [_gated(rule(i), states, reports) for rule, reports, carrier in RULES if carrier in carried_by]


def all_exceptions(i: Inputs) -> DataFrame:
    """Rows of every rule that may run, before equal ones are merged."""
    frames = _rule_rows(i, (None, "order", "payout"))
    if i.completeness is not None:
        c = completeness_exceptions(i.completeness)
        nothing = {
            "expected_amount": F.lit(None).cast(MONEY), "actual_amount": F.lit(None).cast(MONEY),
            "variance": F.lit(None).cast(MONEY), "order_id": F.lit(None).cast("string"),
            "payout_id": F.lit(None).cast("string"), "emitted": F.lit(None).cast("string")
        }
        frames.append(c.withColumns(nothing).select(frames[0].columns))
    if i.conflicts is not None:
        frames.append(conflict_exceptions(i.conflicts))
    return reduce(lambda a, b: a.unionByName(b), frames)


EXCEPTION_KEY = ("rule_id", "exception_type", "entity_type", "entity_id")


def merge_exceptions(raw: DataFrame) -> DataFrame:
    """One row a (rule, type, entity type, entity): the last that was emitted."""
    rest = [c for c in raw.columns if c not in (*EXCEPTION_KEY, "emitted", "order_id", "payout_id")]
    last = F.max_by(F.struct(*rest), F.struct(F.coalesce("emitted", F.lit("")), F.coalesce("payout_id", F.lit(""))))
    return raw.groupBy(*EXCEPTION_KEY).agg(last.alias("x")).select(*EXCEPTION_KEY, "x.*")


def _codes(raw: DataFrame, key: str) -> DataFrame:
    return raw.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.array_sort(F.collect_set("exception_type")).alias("exception_codes")
    )


def _state(states: DataFrame | None, df: DataFrame, reports: tuple[str, ...], blocked: Column) -> DataFrame:
    own = F.when(blocked, "EXCEPTION").otherwise("RECONCILED")
    if states is None:
        return df.withColumn("state", own)
    any_ = lambda s: reduce(lambda a, b: a | b, [F.col("_states")[r] == s for r in reports])
    return df.crossJoin(F.broadcast(states)).withColumn(
        "state", F.when(any_("INCOMPLETE"), "INCOMPLETE").when(any_("PENDING"), "PENDING").otherwise(own)
    ).drop("_states")


def transactions(i: Inputs, raw: DataFrame | None = None) -> DataFrame:
    """Result of each order."""
    raw = reduce(DataFrame.unionByName, _rule_rows(i, ("order",))) if raw is None else raw
    df = i.shared(order_totals).join(_codes(raw, "order_id"), "order_id", "left").withColumn(
        "exception_codes", F.coalesce("exception_codes", F.array().cast("array<string>"))
    )
    df = _state(
        None if i.completeness is None else _states(i.completeness), df, TRANSACTION_REPORTS,
        F.size("exception_codes") > 0
    )
    net = (F.col("captured_total") - F.col("successful_refund_total") - F.col("expected_fee_total")).cast(MONEY)
    return df.select(
        "order_id", F.col("status").alias("order_status"), "currency", "expected_collection", "captured_total",
        variance(F.col("expected_collection"), F.col("captured_total")).alias("collection_variance"),
        "captured_payment_count", "successful_refund_count", "successful_refund_total", "expected_fee_total",
        "reported_fee_total", net.alias("lifetime_net_collection"), "state", "exception_codes"
    )


def payouts(i: Inputs, raw: DataFrame | None = None) -> DataFrame:
    """Result of each payout; a variance against the expected movements blocks it like a code."""
    raw = reduce(DataFrame.unionByName, _rule_rows(i, ("payout",))) if raw is None else raw
    df = i.shared(payout_totals).join(_codes(raw, "payout_id"), "payout_id", "left").withColumn(
        "exception_codes", F.coalesce("exception_codes", F.array().cast("array<string>"))
    )
    df = _state(
        None if i.completeness is None else _states(i.completeness), df, PAYOUT_REPORTS,
        (F.size("exception_codes") > 0) | (F.col("end_to_end_payout_variance") != 0)
    )
    return df.select(
        "payout_id", "payout_date", "currency", "expected_payout", "reported_line_total", "reported_net_amount",
        "provider_report_variance", "end_to_end_payout_variance", "expected_movement_count", "settlement_line_count",
        "state", "exception_codes"
    )


def check_inputs(i: Inputs) -> None:
    """Raise on what no run can settle: two payouts on one date, or not exactly one result for each report."""
    twice = i.payouts.groupBy("payout_date").count().where("count > 1").take(3)
    if twice:
        raise ReconciliationError(f"several payouts on {[str(r[0]) for r in twice]}")
    if i.completeness is not None:
        n = {r[0]: r[1] for r in i.completeness.groupBy("report_type").count().collect()}
        if n != dict.fromkeys(REPORTS, 1):
            raise ReconciliationError(f"completeness must have each report once: {n}")


def reconcile(i: Inputs, run_id: str, detected_at, *, check: bool = True) -> Result:
    """All result frames of one run."""
    if check:
        check_inputs(i)
    i = replace(i, keep=saved, made={})
    # Three results read the rules' rows, so they are written once.
    raw = saved(all_exceptions(i))
    run = {"run_id": F.lit(run_id), "contract_version": F.lit(CONTRACT_VERSION)}
    at = F.lit(detected_at).cast("timestamp")
    return Result(
        transactions(i, raw).withColumns(run),
        payouts(i, raw).withColumns(run),
        expected_movements(i),
        merge_exceptions(raw).withColumns(run | {"detected_at_utc": at, "status": F.lit("OPEN")}),
        i.completeness,
        i.quarantine,
        detected_at,
    )


#: Sort keys of the published frames.
ORDER = {
    "transactions": ("order_id",),
    "payouts": ("payout_date", "payout_id"),
    "movements": ("available_on", "movement_type", "movement_id"),
    "exceptions": ("exception_type", "entity_type", "entity_id", "rule_id"),
    "completeness": ("business_date", "source_system", "report_type"),
    "quarantine": ("entity_type", "source_id", "reason_code"),
}
