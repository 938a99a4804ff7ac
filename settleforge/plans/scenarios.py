"""Scenario files: one JSON object with inputs, report modes and what must come out.

``python -m settleforge.plans.scenarios run PATH`` runs a file or a folder of
files and compares every section that a file's ``expected`` names.
"""

from __future__ import annotations

import argparse
import difflib
import hashlib
import json
import sys
from dataclasses import dataclass
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import canonical, completeness
from ..operators.reconcile import Inputs, Result, reconcile
from ..schemas import REPORTS
from ..sources.validate import validate
from .checkpoints import saved

MODES = (
    "VALID", "MISSING", "DATA_ONLY", "MANIFEST_ONLY", "INVALID_MANIFEST", "ROW_COUNT_MISMATCH", "CHECKSUM_MISMATCH"
)


class ScenarioError(ValueError):
    """A scenario file cannot be read."""


@dataclass
class Outcome:
    scenario_id: str
    actual: dict
    differences: list[str]
    result: Result

    @property
    def passed(self) -> bool:
        return not self.differences


def _time(text: str, field: str) -> datetime:
    try:
        t = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except (AttributeError, ValueError) as e:
        raise ScenarioError(f"{field} is not a timestamp") from e
    if t.tzinfo is None:
        raise ScenarioError(f"{field} needs an offset")
    return t.astimezone(timezone.utc)


def discover(path: str | Path) -> list[Path]:
    """A file itself, or the JSON files of a folder in order."""
    path = Path(path)
    if path.is_file():
        return [path]
    found = sorted(path.glob("*.json")) if path.is_dir() else []
    if not found:
        raise ScenarioError(f"no scenarios at {path}")
    return found


def read_rows(doc: dict) -> dict[str, list[tuple[str, str]]]:
    """(receipt id, payload) of each report; rows may be wrapped as {receipt_id, payload}."""
    unknown = set(doc.get("inputs", {})) - set(REPORTS)
    if unknown:
        raise ScenarioError(f"unknown inputs: {sorted(unknown)}")
    out = {}
    for report in REPORTS:
        rows = []
        for n, row in enumerate(doc.get("inputs", {}).get(report, []), 1):
            wrapped = isinstance(row, dict) and set(row) == {"receipt_id", "payload"}
            rows.append(
                (
                    row["receipt_id"] if wrapped else f"{report}.json:{n}",
                    json.dumps(row["payload"] if wrapped else row, ensure_ascii=False)
                )
            )
        out[report] = rows
    return out


def report_evidence(
    spark: SparkSession, doc: dict, rows: dict[str, list[tuple[str, str]]], day: str, as_of: datetime
) -> DataFrame:
    """Evidence of each report from its mode; reports that the file does not name are missing."""
    out = []
    for report, given in doc.get("reports", {}).items():
        if report not in REPORTS:
            raise ScenarioError(f"unknown report {report}")
        mode = str(given.get("mode", "VALID")).upper()
        if mode not in MODES:
            raise ScenarioError(f"unknown mode {mode} of {report}")
        if mode == "MISSING":
            continue
        received = _time(given.get("received_at_utc", as_of.isoformat()), f"{report}.received_at_utc")
        generated = _time(given.get("generated_at_utc", received.isoformat()), f"{report}.generated_at_utc")
        batch, system = given.get("batch_id", f"{doc['scenario_id']}-{report}-{day}"), REPORTS[report][1]
        n, sha = len(rows[report]), hashlib.sha256(
            json.dumps([json.loads(p) for _, p in rows[report]], sort_keys=True, separators=(",", ":")).encode()
        ).hexdigest()
        date = datetime.fromisoformat(day).date()
        data = mode != "MANIFEST_ONLY"
        manifest, sound = mode != "DATA_ONLY", mode not in ("DATA_ONLY", "INVALID_MANIFEST")
        out.append(
            (
                report, date, data, batch, system, report, date, received, n, sha, manifest,
                None if sound or not manifest else "not valid",
                *((batch, system, report, date) if sound else (None,) * 4), received, generated if sound else None,
                n + (mode == "ROW_COUNT_MISMATCH") if sound else None,
                ("0" * 64 if mode == "CHECKSUM_MISMATCH" else sha) if sound else None
            )
        )
    return spark.createDataFrame(out, completeness.EVIDENCE.replace("\n", " "))


def run_scenario(spark: SparkSession, path: str | Path | dict) -> Outcome:
    """Run one scenario and compare it with its ``expected`` sections."""
    doc = path if isinstance(path, dict) else json.loads(Path(path).read_text())
    as_of, day = _time(doc["as_of"], "as_of"), doc["business_date"]
    rows = read_rows(doc)
    good, bad, typed = [], [], {}
    for report, (entity, _, _) in REPORTS.items():
        df = spark.createDataFrame(rows[report], "receipt_id string, payload string")
        # Seventeen rules read these frames, so they are written once.
        ok, no = map(saved, validate(df, entity))
        typed[entity] = ok.select("receipt_id", "record")
        good.append(ok.drop("record"))
        bad.append(no)
    receipts, quarantine = good[0], bad[0]
    for g, b in zip(good[1:], bad[1:], strict=True):
        receipts, quarantine = receipts.unionByName(g), quarantine.unionByName(b)
    canonical.check_receipts(receipts)
    receipts = canonical.unique_receipts(receipts)
    receipts, quarantine = saved(receipts), saved(quarantine)
    frames = {e: saved(df) for e, df in canonical.current_frames(receipts, typed).items()}
    days = spark.createDataFrame([(datetime.fromisoformat(day).date(),)], "business_date date")
    done = completeness.evaluate(
        completeness.spine(spark, days), report_evidence(spark, doc, rows, day, as_of), F.lit(as_of).cast("timestamp")
    )
    done = saved(done)
    i = Inputs(
        frames["ORDER"], frames["PAYMENT"], frames["REFUND"], frames["FEE"], frames["SETTLEMENT_LINE"],
        frames["PAYOUT"], done, canonical.conflicts(receipts), quarantine.drop("receipt_id")
    )
    run_id = doc.get("run_id", f"scenario-{doc['scenario_id']}")
    result = reconcile(i, run_id, as_of)
    view = {
        "evidence_summary": canonical.evidence_counts(canonical.evidence(receipts), quarantine),
        "source_completeness": done.drop("reason", "deadline_at_utc", "issue_codes"),
        "transactions": result.transactions,
        "expected_movements": result.movements,
        "payouts": result.payouts,
        "exceptions": result.exceptions,
        "quarantine_records": quarantine.drop("receipt_id", "reason_detail"),
    }
    want = doc.get("expected", {})
    actual = {k: _plain(view[k]) for k in (want or view)}
    return Outcome(doc["scenario_id"], actual, [d for k in want for d in _difference(k, want[k], actual[k])], result)


def _plain(df: DataFrame) -> list[dict]:
    """Rows as JSON values: money and dates as text; in a fixed order."""
    kinds = {
        f.name: f.dataType for f in df.schema.fields if f.name not in (
            "run_id", "contract_version", "detected_at_utc", "status"
        )
    }
    cols = [
        F.col(n).cast("string").alias(n) if isinstance(
            k, (T.DecimalType, T.DateType, T.TimestampType)
        ) else F.col(n) for n,
        k in kinds.items()
    ]
    return sorted(
        (r.asDict(recursive=True) for r in df.select(*cols).collect()),
        key=lambda r: json.dumps(r, sort_keys=True, default=str)
    )


def _difference(name: str, want, got: list[dict]) -> list[str]:
    """Differences of a section: each expected row must match a row on the keys that it names, and no row may be left."""
    want = want if isinstance(want, list) else [want]
    left, out = list(got), []
    for w in want:
        hit = next((g for g in left if all(g.get(k) == v for k, v in w.items())), None)
        if hit is None:
            out.append(f"{name}: no row like {json.dumps(w, sort_keys=True)}")
        else:
            left.remove(hit)
    out += [f"{name}: unexpected {json.dumps(g, sort_keys=True)}" for g in left]
    if out:
        dump = lambda x: json.dumps(x, indent=1, sort_keys=True).splitlines()
        out.append("\n".join(difflib.unified_diff(dump(want), dump(got), "expected", "actual", lineterm="")))
    return out


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="scenarios", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="run a scenario file or a folder of them")
    run.add_argument("path")
    run.add_argument("--output", help="write the actual sections as JSON")
    args = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    failed, out = 0, {}
    for path in discover(args.path):
        try:
            o = run_scenario(spark, path)
        except (ScenarioError, KeyError, ValueError) as e:
            print(f"ERROR {path.name}: {e}")
            failed += 1
            continue
        print(("PASS " if o.passed else "FAIL ") + o.scenario_id)
        for d in o.differences:
            print("  " + d)
        failed += not o.passed
        out[o.scenario_id] = o.actual
    if args.output:
        Path(args.output).write_text(json.dumps(out, indent=1, sort_keys=True))
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
