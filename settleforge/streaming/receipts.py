"""Receipts as a stream: take up new ones, say what each changes, keep a list of what must be rebuilt.

No watermark drops anything here: what comes late is classified and replayed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from .clickstream import cadence
from .state import EvidenceState


def stream(
    receipts: DataFrame, path: str, checkpoint: str, on_change: Callable[[DataFrame, int], None],
    every: str | None = None, buckets: int = 64
) -> StreamingQuery:
    """Take the receipts of a streaming frame up into the state under ``path`` and hand the changes of each batch on.

    A batch is committed before it is handed on.  One that Spark runs again after a
    crash is handed on again with the same number and the same rows, so ``on_change``
    should key what it does by the number.
    ``every``: how often, such as "30 seconds"; without it what is there is taken up and the query ends.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        on_change(EvidenceState(batch.sparkSession, path, buckets).apply(batch, batch_id), batch_id)

    return receipts.writeStream.foreachBatch(sink).option(
        "checkpointLocation", checkpoint
    ).trigger(**cadence(every)).start()
