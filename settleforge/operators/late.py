"""Late data: which business dates a receipt affects, and whether it arrived after a published run.

The watermark is the receipt time up to which a published run had seen input; it
is compared as a plain column and nothing is ever dropped because of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import business_date, delay_seconds

NEW, CORRECTION, CONFLICT, DUPLICATE, STALE = "NEW_RECORD", "CORRECTION", "CONFLICT", "EXACT_DUPLICATE", "STALE_VERSION"
_DATES = "array<date>"


def resolve_impact(
    records: DataFrame, payments: DataFrame, payouts: DataFrame, orders_by_creation: bool = False
) -> DataFrame:
    """Dates that each record affects, or why they are unknown.

    ``records``: entity_type, source_id, and as far as the entity has them
    available_on, payment_id, payout_id, payout_date, created_at_utc.  Fees take
    their payment's date, settlement lines their payout's.  Orders stay
    unresolved unless ``orders_by_creation``.
    """
    p = payments.groupBy(F.col("payment_id").alias("_p")).agg(F.max("available_on").alias("_pay_on"))
    o = payouts.groupBy(F.col("payout_id").alias("_o")).agg(F.max("payout_date").alias("_out_on"))
    df = records.join(p, F.col("payment_id") == F.col("_p"), "left").join(o, F.col("payout_id") == F.col("_o"), "left")
    kind = F.col("entity_type")
    order = business_date(F.col("created_at_utc")) if orders_by_creation else F.lit(None).cast("date")
    day = F.when(kind.isin("PAYMENT", "REFUND"), F.col("available_on")).when(kind == "FEE", F.col("_pay_on")).when(
        kind == "SETTLEMENT_LINE", F.col("_out_on")
    ).when(kind == "PAYOUT", F.col("payout_date")).when(kind == "ORDER", order)
    why = F.when(
        kind.isin("PAYMENT", "REFUND"), F.concat(kind, F.lit(" has no available_on date"))
    ).when(kind == "FEE", "FEE needs its payment's available_on date").when(kind == "SETTLEMENT_LINE", "SETTLEMENT_LINE needs its payout's date").when(kind == "PAYOUT", "PAYOUT has no payout_date").when(kind == "ORDER", "ORDER has no effective date").otherwise(F.concat(F.lit("unsupported entity type "), kind))
    df = df.withColumn("affected_date", day).withColumn(
        "unresolved_reason", F.when(F.col("affected_date").isNull(), why)
    )
    return df.drop("_p", "_o", "_pay_on", "_out_on")


def candidates(changes: DataFrame, impacts: DataFrame) -> DataFrame:
    """One row a changed receipt with the dates of its old and new version.

    ``changes``: receipt_id, entity_type, source_id, source_version,
    received_at_utc, change_kind; ``impacts``: receipt_id, affected_date,
    unresolved_reason of the incoming and, if there is one, the previous record.
    """
    i = impacts.groupBy("receipt_id").agg(
        F.array_sort(F.collect_set("affected_date")).alias("affected_dates"),
        F.array_sort(F.collect_set("unresolved_reason")).alias("_why")
    )
    df = changes.join(i, "receipt_id", "left").withColumn(
        "affected_dates", F.coalesce("affected_dates", F.array().cast(_DATES))
    )
    return df.withColumn("unresolved_reason", F.when(F.size("_why") > 0, F.array_join("_why", "; "))).drop("_why")


def classify(cands: DataFrame, run_id: Column, watermark: Column, covered_through: Column) -> DataFrame:
    """Classification of each candidate against one published boundary.

    A duplicate or stale version changes nothing; what was received by the
    watermark is within it; an unknown impact is taken for late (fail closed);
    without a date up to ``covered_through`` the impact is in the future; the rest is late.
    """
    historical = F.filter("affected_dates", lambda d: d <= covered_through)
    df = cands.withColumn("historical_dates", historical)
    kind = F.when(
        F.col("change_kind").isin(DUPLICATE, STALE), "NO_LOGICAL_CHANGE"
    ).when(F.col("received_at_utc") <= watermark, "WITHIN_WATERMARK").when(F.col("unresolved_reason").isNotNull(), "UNRESOLVED_IMPACT").when(F.size("historical_dates") == 0, "FUTURE_IMPACT")
    kind = kind.when(
        F.col("change_kind") == CORRECTION, "LATE_CORRECTION"
    ).when(F.col("change_kind") == CONFLICT, "LATE_CONFLICT").otherwise("LATE_NEW_FACT")
    df = df.withColumns(
        {
            "classification": kind, "boundary_run_id": run_id, "input_watermark_utc": watermark,
            "covered_through_date": covered_through
        }
    )
    late = F.startswith("classification", F.lit("LATE_"))
    return df.withColumns(
        {
            "is_late": late, "requires_reprocessing": late | (F.col("classification") == "UNRESOLVED_IMPACT"),
            "arrived_after_watermark": F.col("received_at_utc") > watermark,
            "arrival_delay_seconds": delay_seconds(F.col("received_at_utc"), watermark)
        }
    )


def current_runs(receipts: DataFrame, runs: DataFrame, time_col: str = "received_at_utc") -> DataFrame:
    """Receipts with the run that was current when they came in: the last one published by then.

    ``runs``: run_id, published_at_utc, input_watermark_utc, covered_through_date;
    their columns are added, null before the first run.  An as-of join by a union:
    receipts and runs are put on one time line and the last run is carried on.  The
    line is cut into hours, each opened by the run that was current at its start, so
    no task holds more than an hour's; only hours and runs, which are few, are put in
    one order.  Of runs published at one time the largest id counts.
    """
    run, no_run = F.struct("run_id", "published_at_utc", "input_watermark_utc", "covered_through_date"), F.lit(None)
    rows = receipts.select(F.struct(*[F.col(f"`{c}`") for c in receipts.columns]).alias("_row"), F.col(time_col).alias("_t"))
    rows = rows.withColumn("_d", F.date_trunc("hour", "_t"))
    line = runs.select(run.alias("_run"), F.col("published_at_utc").alias("_t")).withColumn("_d", F.date_trunc("hour", "_t"))
    kind, no_row = line.schema["_run"].dataType, F.lit(None).cast(rows.schema["_row"].dataType)
    # A run published on the hour belongs to its own hour, not to what opens it.
    starts = rows.select("_d").distinct().select("_d", F.col("_d").alias("_t"), no_run.cast(kind).alias("_run"), F.lit(0).alias("_k"))
    every = Window.orderBy("_t", "_k", "_run.run_id").rowsBetween(Window.unboundedPreceding, 0)
    opened = starts.unionByName(line.withColumn("_k", F.lit(1)))
    opened = opened.withColumn("_run", F.last("_run", ignorenulls=True).over(every)).where("_k = 0")
    both = rows.select("_d", "_t", "_row", no_run.cast(kind).alias("_run"), F.lit(2).alias("_k"))
    for more in (line.withColumn("_k", F.lit(1)), opened):
        both = both.unionByName(more.withColumn("_row", no_row))
    hour = Window.partitionBy("_d").orderBy("_t", "_k", "_run.run_id").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_run", F.last("_run", ignorenulls=True).over(hour)).where("_row IS NOT NULL")
    return out.select("_row.*", "_run.*")


def classify_by_runs(cands: DataFrame, runs: DataFrame) -> DataFrame:
    """``classify`` of each candidate against the run that was current when it came in.

    Before the first run nothing is late: such a candidate is NOT_YET_PUBLISHED
    (unless it changes nothing) and needs no reprocessing.
    """
    df = current_runs(cands, runs).withColumnsRenamed(
        {"run_id": "_id", "input_watermark_utc": "_mark", "covered_through_date": "_covered"}
    )
    out = classify(df, F.col("_id"), F.col("_mark"), F.col("_covered"))
    first = F.col("_id").isNull() & (F.col("classification") != "NO_LOGICAL_CHANGE")
    no = {c: F.when(first, False).otherwise(F.col(c)) for c in ("is_late", "requires_reprocessing")}
    no |= {"arrived_after_watermark": F.coalesce("arrived_after_watermark", F.lit(False))}
    return out.withColumns({"classification": F.when(first, "NOT_YET_PUBLISHED").otherwise(F.col("classification"))} | no).drop(
        "_id", "_mark", "_covered"
    )


def change_kinds(receipts: DataFrame, known: DataFrame) -> DataFrame:
    """What each new receipt does to the known receipts of its entity.

    Higher version: a correction; same version and one of its payloads: a duplicate;
    same version, other payload: a conflict; lower version: stale; no entity yet: new.
    """
    who = ["source_system", "entity_type", "source_id"]
    # All payloads of the highest version: an entity in conflict has several.
    top = known.groupBy(*who, "source_version").agg(F.collect_set("payload_hash").alias("_h")).groupBy(*who).agg(
        F.max("source_version").alias("_top"), F.max_by("_h", "source_version").alias("_hashes")
    )
    return kinds_by_top(receipts, top)


def kinds_by_top(receipts: DataFrame, top: DataFrame) -> DataFrame:
    """``change_kinds`` against the highest version of each known entity (``_top``) and its payloads (``_hashes``)."""
    df = receipts.join(top, ["source_system", "entity_type", "source_id"], "left")
    kind = F.when(F.col("_top").isNull(), NEW).when(F.col("source_version") > F.col("_top"), CORRECTION).when(
        F.col("source_version") < F.col("_top"), STALE
    ).when(F.array_contains("_hashes", F.col("payload_hash")), DUPLICATE).otherwise(CONFLICT)
    return df.withColumn("change_kind", kind).drop("_top", "_hashes")
