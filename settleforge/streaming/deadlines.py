"""Completeness of reports as a stream: a deadline passes without a row, and the report is incomplete from its very second on.

Each expected report is a key with state: what it is now, and a timer at its deadline.
Time is event time; a stream of ticks (``TICK``: rows without a report) moves it on
where no report comes, such as Spark's ``rate`` source, or what a test feeds in.
Changes of state are dated by what caused them, the deadline or the receipt, so the
result does not depend on how rows fall into batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.completeness import evaluate, spine

#: Rows of the stream: a report, whether all that was received of it by ``at`` makes it complete, and its deadline.
EVENT = "report_type string, business_date date, at timestamp, complete boolean, deadline timestamp"
CHANGE = "report_type string, business_date date, at timestamp, state string"
_STATE = "state string, deadline_us long"


def tick(at: Column) -> list[Column]:
    """The columns of a row that only says that it is ``at``."""
    none = {"report_type": "string", "business_date": "date", "complete": "boolean", "deadline": "timestamp"}
    return [
        at.alias(c) if c == "at" else F.lit(None).cast(none[c]).alias(c)
        for c in ("report_type", "business_date", "at", "complete", "deadline")
    ]


def report_events(days: DataFrame, evidence: DataFrame, expected_from: Column) -> DataFrame:
    """The stream's rows: each report of ``days`` expected from a time on, and judged whenever some of it was received.

    ``evidence`` as in ``completeness.evaluate``, ``expected_from`` an expression of business_date.
    """
    spark, at = days.sparkSession, F.col("_at")
    due = spine(spark, days).withColumn("_at", expected_from)
    got = evidence.select("report_type", "business_date", F.explode(F.array("data_received", "m_received")).alias("_at"))
    got = got.where("_at IS NOT NULL").join(spine(spark, days), ["report_type", "business_date"]).select(*due.columns)
    return evaluate(due.unionByName(got).distinct(), evidence, at, keep=("_at",)).select(
        "report_type", "business_date", at.alias("at"), (F.col("state") == "COMPLETE").alias("complete"),
        F.col("deadline_at_utc").alias("deadline")
    )


def changes(events: DataFrame, late: str = "0 seconds") -> DataFrame:
    """(report_type, business_date, at, state) of each change of state, from a streaming frame of ``EVENT`` rows.

    ``late``: how much later than others a row may come in; time lags that much.
    """

    def update(
        key: tuple, batches: Iterator[pd.DataFrame], held: GroupState
    ) -> Iterator[pd.DataFrame]:
        report, day = key
        if report is None or pd.isna(report):
            for _ in batches:
                pass
            return
        state, due = held.get if held.exists else (None, None)
        out = []

        def passes(to: int) -> None:
            """Time has come to ``to``: what was pending at its deadline is incomplete since."""
            nonlocal state
            if state == "PENDING" and due is not None and to >= due:
                state = "INCOMPLETE"
                out.append((due, state))

        rows = [b for b in batches if len(b)]
        if rows:
            for at, complete, limit in sorted(
                (int(r.at.value // 1000), bool(r.complete), int(r.deadline.value // 1000))
                for b in rows for r in b.itertuples()
            ):
                due = limit if due is None else due
                passes(at)
                new = "COMPLETE" if complete else "PENDING" if at < due else "INCOMPLETE"
                if new != state:
                    state = new
                    out.append((at, state))
        passes(held.getCurrentWatermarkMs() * 1000)
        if state is not None:
            held.update((state, due))
            if state == "PENDING":
                # A timer fires once time is beyond it, so it is set a moment before the deadline's millisecond.
                held.setTimeoutTimestamp(max(due // 1000 - 1, held.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame(
                {
                    "report_type": [report] * len(out), "business_date": [day] * len(out),
                    "at": pd.to_datetime([t for t, _ in out], unit="us"), "state": [s for _, s in out]
                }
            )

    rows = events.withWatermark("at", late)
    return rows.groupBy("report_type", "business_date").applyInPandasWithState(
        update, CHANGE, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def states(changed: DataFrame, as_of: Column) -> DataFrame:
    """(report_type, business_date, state) as of a time, from the changes until then."""
    # Of changes at one time the last is the better one: first the deadline passes, then what has come is judged.
    rank = F.struct("at", F.when(F.col("state") == "COMPLETE", 1).otherwise(0))
    seen = changed.where(F.col("at") <= as_of)
    return seen.groupBy("report_type", "business_date").agg(F.max_by("state", rank).alias("state"))
