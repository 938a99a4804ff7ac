"""The current version of every entity, and what became of every receipt.

One shuffle by identity settles everything: the highest version wins, and it is
accepted if all its payloads are the same, or else the entity is in conflict.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ENTITIES

IDENTITY = ("source_system", "entity_type", "source_id")


class EvidenceError(ValueError):
    """Receipts contradict each other in a way that no rule settles."""


def unique_receipts(receipts: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """One row a receipt id.  Receipts with one id must agree; ``reused_receipts`` finds those that do not.

    ``within``: columns that follow from the id; receipts that lie by some of them already are not shuffled.
    """
    return receipts.dropDuplicates([*within, "receipt_id"])


def reused_receipts(receipts: DataFrame) -> DataFrame:
    """Receipt ids that stand for different contents."""
    content = F.struct(*IDENTITY, "source_version", "payload_hash")
    return receipts.groupBy("receipt_id").agg(
        F.min(content).alias("lo"), F.max(content).alias("hi")
    ).where("lo <> hi").select("receipt_id")


def check_receipts(receipts: DataFrame) -> None:
    """Raise if a receipt id is used twice with different contents."""
    bad = reused_receipts(receipts).take(5)
    if bad:
        raise EvidenceError(f"receipt ids reused with different contents: {[r[0] for r in bad]}")


def evidence(receipts: DataFrame, first_seen: str | None = None) -> DataFrame:
    """Disposition of each receipt: ACCEPTED, DUPLICATE, STALE or CONFLICTED, with a reason.

    ``receipts``: receipt_id, IDENTITY, source_version, payload_hash (others stay).
    The representative of equal receipts is the smallest receipt id, or with
    ``first_seen`` (a timestamp column) the earliest.
    """
    # Ids differ most, so they are compared first where rows are sorted.
    one = IDENTITY[::-1]
    who = Window.partitionBy(*one)
    order = ["receipt_id"] if first_seen is None else [first_seen, "receipt_id"]
    same = Window.partitionBy(*one, "source_version", "payload_hash").orderBy(*order)
    # The window with the longer order first: its sort serves the other too.
    df = receipts.withColumn("_n", F.row_number().over(same))
    # The least and the greatest payload of the highest version, in the pass that finds that version.
    payload, some = F.col("payload_hash"), F.col("source_version").isNotNull()
    least = F.min(F.when(some, F.struct(F.bitwise_not("source_version"), payload.isNull(), payload.alias("h"))))
    most = F.max(F.when(some, F.struct("source_version", payload.alias("h"))))
    df = df.withColumns(
        {
            "_top": F.max("source_version").over(who), "_lo": least.over(who)["h"], "_hi": most.over(who)["h"]
        }
    )
    won = F.col("source_version") == F.col("_top")
    split = F.col("_lo") != F.col("_hi")
    disposition = F.when(~won, "STALE").when(split, "CONFLICTED").when(
        F.col("_n") > 1, "DUPLICATE"
    ).otherwise("ACCEPTED")
    reason = F.when(~won, "a higher version is known").when(split, "one version with different payloads").when(
        F.col("_n") > 1, "same version and payload as the accepted receipt"
    ).otherwise("current version")
    return df.withColumns({"disposition": disposition, "reason": reason}).drop("_top", "_n", "_lo", "_hi")


def canonical(receipts: DataFrame, first_seen: str | None = None) -> DataFrame:
    """The accepted receipt of each entity without conflict; ``first_seen`` as in ``evidence``."""
    return evidence(receipts, first_seen).where("disposition = 'ACCEPTED'").drop("disposition", "reason")


def conflicts(receipts: DataFrame) -> DataFrame:
    """Entities whose highest version has several payloads, with the sorted payloads and receipts."""
    bad = evidence(receipts).where("disposition = 'CONFLICTED'")
    return bad.groupBy(*IDENTITY, "source_version").agg(
        F.array_sort(F.collect_set("payload_hash")).alias("payload_hashes"),
        F.array_sort(F.collect_set("receipt_id")).alias("receipt_ids")
    )


def evidence_counts(ev: DataFrame, quarantined: DataFrame | None = None) -> DataFrame:
    """One row of counts by disposition."""
    out = ev.agg(
        F.count(F.lit(1)).alias("unique_receipts"),
        *[F.count_if(F.col("disposition") == d).alias(d.lower()) for d in ("ACCEPTED", "STALE", "DUPLICATE", "CONFLICTED")]
    )
    n = quarantined.agg(
        F.count(F.lit(1)).alias("quarantined")
    ) if quarantined is not None else ev.sparkSession.range(1).select(F.lit(0).cast("long").alias("quarantined"))
    return out.crossJoin(n)


def records(current: DataFrame, entity: str) -> DataFrame:
    """The typed columns of one entity's current records."""
    return current.where(F.col("entity_type") == entity).select("record.*")


class ReplayLedger:
    """Receipts gathered batch by batch; an exact replay adds nothing, a bad batch changes nothing."""

    def __init__(self, receipts: DataFrame | None = None):
        self._receipts = receipts

    def apply(self, batch: DataFrame) -> int:
        """Add a batch; returns the number of new receipts.  Raises on reused ids and keeps the old state then."""
        merged = batch if self._receipts is None else self._receipts.unionByName(batch)
        check_receipts(merged)
        new = unique_receipts(batch)
        if self._receipts is not None:
            new = new.join(self._receipts.select("receipt_id"), "receipt_id", "left_anti")
        added = new.count()
        if added:
            new = new.select(batch.columns)
            self._receipts = new if self._receipts is None else self._receipts.unionByName(new)
        return added

    def receipts(self) -> DataFrame | None:
        return self._receipts

    def result(self) -> DataFrame:
        """Evidence over all receipts so far."""
        if self._receipts is None:
            raise EvidenceError("the ledger is empty")
        return evidence(self._receipts)


def current_frames(receipts: DataFrame, per_entity: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Current records by entity from receipts and each entity's typed receipts (receipt_id, record)."""
    won = canonical(unique_receipts(receipts)).select("receipt_id")
    return {
        e: per_entity[e].join(won, "receipt_id", "left_semi").select("record.*") for e in ENTITIES if e in per_entity
    }
