"""Drains the recovery queue from a command line, with a builder named as ``module:function``."""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from collections.abc import Callable

from pyspark.sql import SparkSession

from .recovery import Queue, Worker, drain
from .rebuild import rebuild
from .store import FileSystem, Store


def load_callable(path: str) -> Callable:
    """The function that ``module:function`` names."""
    module, colon, name = path.partition(":")
    if not (module and colon and name) or ":" in name:
        raise ValueError(f"{path!r} is not of the form module:function")
    found = getattr(importlib.import_module(module), name)
    if not callable(found):
        raise TypeError(f"{path} is not callable")
    return found


def stored_evidence(spark: SparkSession, ledger_root: str) -> Callable:
    """The default builder: everything in the ledger as of the request."""
    from ..sources.ledger import Ledger

    ledger = Ledger(spark, ledger_root)
    return lambda run_id, as_of: rebuild(ledger, run_id, as_of)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="runner", description=__doc__)
    p.add_argument("--control", required=True, help="folder of the queue")
    p.add_argument("--results", required=True, help="folder of published results")
    p.add_argument("--ledger", required=True, help="folder of the ingestion ledger")
    p.add_argument(
        "--builder",
        default=f"{__name__}:stored_evidence" if __name__ != "__main__" else "settleforge.plans.runner:stored_evidence",
        help="module:function called with the session and the ledger folder; returns what makes a result of (run_id, as_of)"
    )
    p.add_argument("--max-requests", type=int, default=10)
    p.add_argument("--max-seconds", type=float, default=300.0)
    args = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    build = load_callable(args.builder)(spark, args.ledger)
    worker = Worker(Queue(FileSystem(spark, args.control)), Store(spark, args.results), build)
    done = drain(worker, max_requests=args.max_requests, max_seconds=args.max_seconds)
    print(json.dumps(done))
    return int(done["failed"] > 0)


if __name__ == "__main__":
    sys.exit(main())
