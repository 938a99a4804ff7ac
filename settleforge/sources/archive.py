"""Content-addressed archive of report files."""

from __future__ import annotations

import hashlib
import json
import os
import re
import shutil
from datetime import date, datetime
from pathlib import Path

from ..schemas import REPORTS


class ArchiveError(ValueError):
    """A file is not what its checksum says."""


def checksum_of(path: Path) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            h.update(block)
    return h.hexdigest()


def relative_path(report_type: str, report_date: date, checksum: str) -> Path:
    if report_type.lower() not in REPORTS:
        raise ValueError(f"unknown report type {report_type}")
    if not isinstance(report_date, date) or isinstance(report_date, datetime):
        raise TypeError("report_date must be a date")
    if not re.fullmatch(r"[0-9a-f]{64}", checksum):
        raise ValueError("checksum must be 64 lower-case hex digits")
    return Path(report_type.upper()) / report_date.isoformat() / checksum[:2] / f"{checksum}.json"


def archive(root: Path, source: Path, report_type: str, report_date: date, checksum: str) -> tuple[Path, bool]:
    """Move a file into the archive; returns its place and whether it was there already.

    Safe to repeat: a copy is made beside the target, checked and renamed, and
    the source goes only after that.
    """
    target = Path(root) / relative_path(report_type, report_date, checksum)
    if target.exists():
        if checksum_of(target) != checksum:
            raise ArchiveError(f"archived file {target} is damaged")
        if source.exists():
            source.unlink()
        return target, True
    if checksum_of(source) != checksum:
        raise ArchiveError(f"{source} does not have checksum {checksum}")
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_suffix(".part")
    shutil.copyfile(source, part)
    if checksum_of(part) != checksum:
        part.unlink()
        raise ArchiveError(f"the copy of {source} is damaged")
    os.replace(part, target)
    source.unlink()
    return target, False


def restore(root: Path, report_type: str, report_date: date, checksum: str, to: Path) -> Path:
    """Copy an archived file back and check it."""
    source = Path(root) / relative_path(report_type, report_date, checksum)
    shutil.copyfile(source, to)
    if checksum_of(to) != checksum:
        raise ArchiveError(f"archived file {source} is damaged")
    return to


class ArchiveLog:
    """What became of each delivery's file: PENDING, ARCHIVED or FAILED; anything but ARCHIVED is tried again.

    States are small JSON files in the control folder ``files`` (see
    ``plans.store.FileSystem``); evidence in the ledger does not depend on them.
    """

    def __init__(self, files, root: Path, max_attempts: int = 5):
        self.files, self.root, self.max_attempts = files, Path(root), max_attempts

    def request(self, key: str, source: Path, report_type: str, report_date: date, checksum: str) -> dict:
        """Ask for a file to be archived; asking again changes nothing."""
        relative_path(report_type, report_date, checksum)
        state = {
            "key": key, "source": str(source), "report_type": report_type, "report_date": report_date.isoformat(),
            "checksum": checksum, "status": "PENDING", "attempts": 0
        }
        self.files.create(f"archive/{key}.json", json.dumps(state, sort_keys=True))
        return self.state(key)

    def state(self, key: str) -> dict | None:
        text = self.files.read(f"archive/{key}.json")
        return None if text is None else json.loads(text)

    def states(self) -> list[dict]:
        return [self.state(n[:-5]) for n in self.files.names("archive") if n.endswith(".json")]

    def run(self) -> list[dict]:
        """Archive what is not archived and has attempts left; returns the states of those tried."""
        out = []
        for s in self.states():
            if s["status"] == "ARCHIVED" or s["attempts"] >= self.max_attempts:
                continue
            s["attempts"] += 1
            try:
                target, _ = archive(
                    self.root, Path(s["source"]), s["report_type"], date.fromisoformat(s["report_date"]), s["checksum"]
                )
                s |= {"status": "ARCHIVED", "path": str(target)}
                s.pop("error", None)
            except (OSError, ValueError) as e:
                s |= {"status": "FAILED", "error": f"{type(e).__name__}: {e}"}
            self.files.write(f"archive/{s['key']}.json", json.dumps(s, sort_keys=True))
            out.append(s)
        return out
