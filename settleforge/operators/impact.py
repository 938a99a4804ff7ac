"""Which orders, payouts and days a change reaches: closure over the dependency graph.

Nodes are records and days.  A record is tied to its parents, both ways, and to
its day; a day is tied to every record on it, since a payout adds up all
movements of its day.  The closure walks frontier by frontier with equi-joins;
only counts come to the driver, and each frontier is written to the shared
checkpoint folder, which cuts the lineage.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import business_day_bounds
from ..plans.checkpoints import saved
from .late import DUPLICATE, STALE

_MOVEMENT = {"CAPTURE": "PAYMENT", "REFUND": "REFUND", "FEE": "FEE"}


@dataclass
class Plan:
    """``scope``: NONE, WINDOWS or FULL; frames are None where nothing is planned.

    ``reasons`` holds why a full rebuild is needed: a few codes, or a frame (reason)
    with a row for each record that could not be bounded, however many there are.
    """

    scope: str
    reasons: list[str] | DataFrame = field(default_factory=list)
    keys: DataFrame | None = None
    dates: DataFrame | None = None

    @property
    def reason_codes(self) -> list[str]:
        """All reasons, in order, on the driver; where there may be many, read the frame."""
        return self.reasons if isinstance(self.reasons, list) else [
            r[0] for r in self.reasons.orderBy("reason").collect()
        ]

    def order_ids(self) -> DataFrame:
        return self.keys.where("entity_type = 'ORDER'").select(F.col("source_id").alias("order_id"))

    def payout_ids(self) -> DataFrame:
        return self.keys.where("entity_type = 'PAYOUT'").select(F.col("source_id").alias("payout_id"))

    def windows(self) -> DataFrame:
        return date_windows(self.dates)


def date_windows(dates: DataFrame, day_col: str = "day") -> DataFrame:
    """Runs of consecutive days as half-open windows (start, end_exclusive)."""
    d = dates.select(F.col(day_col).alias("d")).where("d IS NOT NULL").distinct()
    # Days fall into years first, so that no task numbers all of them; runs that meet at a year's end are joined after.
    y = d.withColumn("y", F.year("d"))
    run = y.withColumn(
        "k", F.date_sub("d", F.row_number().over(Window.partitionBy("y").orderBy("d")))
    ).groupBy("y", "k").agg(F.min("d").alias("start"), F.date_add(F.max("d"), 1).alias("end"))
    w = Window.orderBy("start")
    run = run.withColumn(
        "new", F.coalesce((F.col("start") != F.lag("end").over(w)).cast("int"), F.lit(1))
    ).withColumn("g", F.sum("new").over(w))
    return run.groupBy("g").agg(F.min("start").alias("start"), F.max("end").alias("end_exclusive")).drop("g")


def utc_windows(windows: DataFrame) -> DataFrame:
    """Windows as instants of business days."""
    return windows.select(
        "start", "end_exclusive", business_day_bounds(F.col("start"))[0].alias("start_utc"),
        business_day_bounds(F.col("end_exclusive"))[0].alias("end_utc")
    )


def _node(entity: str | Column, key: Column) -> Column:
    return F.concat(entity if isinstance(entity, Column) else F.lit(entity), F.lit(":"), key)


def _edges(r: DataFrame) -> DataFrame:
    """(u, v) ties of records with entity_type, source_id, order_id, payment_id, payout_id, movement_type, movement_id, available_on, payout_date."""
    kind, me = F.col("entity_type"), _node(F.col("entity_type"), F.col("source_id"))
    moved = F.create_map(*[F.lit(x) for kv in _MOVEMENT.items() for x in kv])[F.col("movement_type")]
    there = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    ties = [
        F.when((kind == "PAYMENT") & there("order_id"), _node("ORDER", F.col("order_id"))),
        F.when(kind.isin("REFUND", "FEE") & there("payment_id"), _node("PAYMENT", F.col("payment_id"))),
        F.when((kind == "SETTLEMENT_LINE") & there("payout_id"), _node("PAYOUT", F.col("payout_id"))),
        F.when(
            (kind == "SETTLEMENT_LINE") & there("movement_id") & moved.isNotNull(), _node(moved, F.col("movement_id"))
        ),
        F.when(kind.isin("PAYMENT", "REFUND"), _node("DAY", F.col("available_on").cast("string"))),
        F.when(kind == "PAYOUT", _node("DAY", F.col("payout_date").cast("string"))),
    ]
    one = r.select(me.alias("u"), F.explode(F.filter(F.array(*ties), lambda x: x.isNotNull())).alias("v"))
    return one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()


def _issues(r: DataFrame) -> DataFrame:
    """(node, reason) of records whose ties cannot be known."""
    kind = F.col("entity_type")
    gone = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    found = [
        F.when((kind == "PAYMENT") & gone("order_id"), "MISSING_RELATIONSHIP_ID"),
        F.when(kind.isin("REFUND", "FEE") & gone("payment_id"), "MISSING_RELATIONSHIP_ID"),
        F.when(
            (kind == "SETTLEMENT_LINE") & (
                gone("payout_id") | (F.col("movement_type").isin(*_MOVEMENT) & gone("movement_id"))
            ),
            "MISSING_RELATIONSHIP_ID"
        ),
        F.when(
            (kind == "SETTLEMENT_LINE") & ~F.coalesce(F.col("movement_type").isin(*_MOVEMENT), F.lit(False)),
            "MOVEMENT_TYPE_UNRESOLVED"
        ),
        F.when(
            (kind == "PAYMENT") & (F.col("status") == "CAPTURED") & F.col("available_on").isNull(),
            "CAPTURE_DATE_UNRESOLVED"
        ),
        F.when(
            (kind == "REFUND") & (F.col("status") == "SUCCEEDED") & F.col("available_on").isNull(),
            "REFUND_DATE_UNRESOLVED"
        ),
        F.when((kind == "PAYOUT") & F.col("payout_date").isNull(), "PAYOUT_DATE_UNRESOLVED"),
        F.when(
            ~kind.isin("ORDER", "PAYMENT", "REFUND", "FEE", "SETTLEMENT_LINE", "PAYOUT"), "ENTITY_IMPACT_UNSUPPORTED"
        ),
    ]
    return r.select(
        _node(kind, F.col("source_id")).alias("node"),
        F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("reason")
    )


def closure(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """All nodes that can be reached from ``seeds`` (node)."""
    edges = saved(edges)
    seen = frontier = saved(seeds.select("node").distinct())
    while True:
        new = saved(
            frontier.join(
                edges, frontier["node"] == edges["u"]
            ).select(F.col("v").alias("node")).distinct().join(seen, "node", "left_anti")
        )
        if new.isEmpty():
            return seen
        seen, frontier = seen.unionByName(new), new


FIELDS = {
    "entity_type": "string", "source_id": "string", "status": "string", "order_id": "string", "payment_id": "string",
    "payout_id": "string", "movement_type": "string", "movement_id": "string", "available_on": "date",
    "payout_date": "date"
}


def impact_records(frames: dict[str, DataFrame], ids: dict[str, str]) -> DataFrame:
    """Frames of several entities in one shape; ``ids``: entity -> id column."""
    out = []
    for entity, df in frames.items():
        given = {"entity_type": F.lit(entity), "source_id": F.col(ids[entity])}
        out.append(
            df.select(
                *[
                    given.get(c, F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c,
                    t in FIELDS.items()
                ]
            )
        )
    return reduce(lambda a, b: a.unionByName(b), out)


def plan(
    before: DataFrame, after: DataFrame, changed: DataFrame, change_kind: str, canonical_changed: bool = True,
    completeness_changed: bool = False
) -> Plan:
    """What to rebuild after a change; anything that cannot be bounded asks for a full rebuild."""
    if completeness_changed:
        return Plan("FULL", ["REPORT_COMPLETENESS_CHANGED"])
    if not canonical_changed or change_kind in (DUPLICATE, STALE):
        return Plan("NONE")
    if changed.isEmpty():
        return Plan("FULL", ["CHANGE_EVIDENCE_MISSING"])
    records = before.unionByName(after).unionByName(changed)
    nodes = closure(_edges(records), changed.select(_node(F.col("entity_type"), F.col("source_id")).alias("node")))
    own = records.select(_node(F.col("entity_type"), F.col("source_id")).alias("node")).distinct()
    day = F.startswith("node", F.lit("DAY:"))
    missing = nodes.where(~day).join(own, "node", "left_anti").select(
        F.concat(F.lit("RELATED_RECORD_MISSING:"), "node").alias("reason")
    )
    reasons = _issues(records).join(nodes, "node", "left_semi").select("reason").unionByName(missing).distinct()
    reasons = saved(reasons.select("reason"))
    keys = nodes.where(~day).select(
        F.regexp_extract("node", r"^([^:]*):", 1).alias("entity_type"),
        F.regexp_extract("node", r"^[^:]*:(.*)$", 1).alias("source_id")
    )
    dates = nodes.where(day).select(F.substring("node", 5, 10).cast("date").alias("day"))
    return Plan("WINDOWS" if reasons.isEmpty() else "FULL", reasons, keys, dates)


def restrict(frames: dict[str, DataFrame], p: Plan, ids: dict[str, str]) -> dict[str, DataFrame]:
    """The records that a windowed rebuild must read: those in the plan's closure."""
    return {
        e: df.join(
            p.keys.where(F.col("entity_type") == e).select(F.col("source_id").alias(ids[e])), ids[e], "left_semi"
        ) for e,
        df in frames.items()
    }
