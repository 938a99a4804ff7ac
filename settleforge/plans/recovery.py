"""The recovery queue: durable rebuild requests with retries, and the worker that drains it.

The queue is a small control log of one JSON file a request, owned by the driver;
financial rows never pass through it.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import datetime, timedelta, timezone

from .store import FileSystem

FAILURE_POINTS = (
    "after_claim", "after_build", "after_validate", "after_rows", "before_pointer", "after_pointer", "before_complete",
    "after_commit"
)


class InjectedFailure(RuntimeError):
    """Raised on purpose by a test hook."""


class FailOnce:
    """Raises the first time that it is called with its point."""

    def __init__(self, point: str):
        if point not in FAILURE_POINTS:
            raise ValueError(f"unknown failure point {point}")
        self.point, self.fired = point, False

    def __call__(self, point: str) -> None:
        if point == self.point and not self.fired:
            self.fired = True
            raise InjectedFailure(point)


class QueueError(ValueError):
    """A request does not exist or is not in the right state."""


@dataclass
class Request:
    request_id: str
    reason_code: str
    as_of_utc: str
    scope: str = "FULL"
    status: str = "PENDING"
    attempt_count: int = 0
    max_attempts: int = 5
    base_retry_delay_seconds: int = 30
    created_at_utc: str = ""
    next_attempt_at_utc: str = ""
    completed_at_utc: str | None = None
    last_error: str | None = None
    result_run_id: str | None = None
    source_batch_status: str = "COMMITTED"
    trigger_batch_id: str = ""
    generation: int = 0


def _text(t: datetime) -> str:
    return t.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def _time(s: str) -> datetime:
    return datetime.fromisoformat(s.replace("Z", "+00:00"))


def retry_delay(attempt: int, base_seconds: int) -> int:
    """Seconds to wait after a failed attempt: doubled each time, an hour at most."""
    return min(3600, base_seconds * 2 ** min(attempt - 1, 12))


class Queue:
    def __init__(self, files: FileSystem, clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc)):
        self.files, self.clock = files, clock

    @staticmethod
    def request_id(change_key: str) -> str:
        return hashlib.sha256(change_key.encode()).hexdigest()[:32]

    def _save(self, r: Request) -> None:
        """A request that is done moves to ``done``, so that open ones are found without reading all."""
        text, name = json.dumps(asdict(r), sort_keys=True), f"{r.request_id}.json"
        there, other = ("queue/done/", "queue/") if r.status != "PENDING" else ("queue/", "queue/done/")
        self.files.write(there + name, text)
        self.files.delete(other + name)

    @staticmethod
    def _parsed(text: str | None) -> Request | None:
        """None for a file that is not there or holds no request."""
        try:
            return None if text is None else Request(**json.loads(text))
        except (ValueError, TypeError):
            return None

    def get(self, request_id: str) -> Request | None:
        """A request; of one that a crash left in both places, what it was when done."""
        done = self._parsed(self.files.read(f"queue/done/{request_id}.json"))
        return done or self._parsed(self.files.read(f"queue/{request_id}.json"))

    def requests(self, open_only: bool = False) -> list[Request]:
        """All requests, or those that are not done; files that hold none are passed over."""
        names = [n for n in self.files.names("queue") if n.endswith(".json")]
        done = set() if open_only else {n for n in self.files.names("queue/done") if n.endswith(".json")}
        found = [self.get(n[:-5]) for n in sorted({*names, *done})]
        return [r for r in found if r and (not open_only or r.status == "PENDING")]

    def enqueue(
        self, change_key: str, reason_code: str, as_of: datetime, *, canonical_changed: bool = True,
        affects_history: bool = True, **options
    ) -> Request | None:
        """A request for a change, one a change key; None where nothing has to be rebuilt."""
        if not (canonical_changed and affects_history):
            return None
        request_id = self.request_id(change_key)
        now = _text(self.clock())
        r = Request(request_id, reason_code, _text(as_of), created_at_utc=now, next_attempt_at_utc=now, **options)
        known = self.get(request_id)
        if known:
            return known
        if self.files.read(f"queue/{request_id}.json") is not None:
            self.files.delete(f"queue/{request_id}.json")  # it holds no request
        # The first of several callers makes the file; the others get what it holds.
        made = self.files.create(f"queue/{request_id}.json", json.dumps(asdict(r), sort_keys=True))
        return r if made else self.get(request_id)

    def _due(self) -> list[Request]:
        now = self.clock()
        due = [r for r in self.requests(open_only=True) if r.status == "PENDING" and _time(r.next_attempt_at_utc) <= now]
        return sorted(due, key=lambda r: (r.next_attempt_at_utc, r.created_at_utc, r.request_id))

    def claim_next(self, owner: str = "worker", lease_seconds: int = 3600) -> Request | None:
        """The due request that has waited longest and that no other worker holds; it is this owner's until the lease ends.

        A claim is a file that only one worker can make, one for each attempt; after
        a lease has run out the next generation of the claim can be made.
        """
        for r in self._due():
            generation = 0
            while True:
                until = self.clock() + timedelta(seconds=lease_seconds)
                text = json.dumps({"owner": owner, "until": _text(until)})
                if self.files.create(self._claim(r, generation), text):
                    r.generation = generation
                    return r
                try:
                    held = _time(json.loads(self.files.read(self._claim(r, generation)) or "")["until"])
                except (ValueError, KeyError, TypeError):
                    held = self.clock()  # it names no owner: nobody holds it
                if held > self.clock():
                    break
                generation += 1
        return None

    @staticmethod
    def _claim(r: Request, generation: int) -> str:
        return f"queue/claims/{r.request_id}-{r.attempt_count}-{generation}"

    def overtaken(self, r: Request) -> bool:
        """Whether another worker has claimed the request since, after this claim's lease ran out."""
        return self.files.exists(self._claim(r, r.generation + 1))

    def next_ready(self) -> Request | None:
        """The pending request that is due and has waited longest."""
        return next(iter(self._due()), None)

    def mark_succeeded(self, request_id: str, run_id: str) -> None:
        r = self.get(request_id)
        if r is None:
            raise QueueError("no such request")
        if r.status != "PENDING":
            raise QueueError(f"request is {r.status}")
        r.status, r.result_run_id, r.completed_at_utc, r.last_error = "SUCCEEDED", run_id, _text(self.clock()), None
        r.attempt_count += 1
        self._save(r)

    def record_failure(self, request_id: str, error: Exception) -> None:
        """Count a failed attempt; a request that is not pending stays as it is."""
        r = self.get(request_id)
        if r is None:
            raise QueueError("no such request")
        if r.status != "PENDING":
            return
        now = self.clock()
        r.attempt_count += 1
        r.last_error = f"{type(error).__name__}: {error}"[:2000]
        r.next_attempt_at_utc = _text(now + timedelta(seconds=retry_delay(r.attempt_count, r.base_retry_delay_seconds)))
        if r.attempt_count >= r.max_attempts:
            r.status, r.completed_at_utc = "FAILED", _text(now)
        self._save(r)

    def requeue_failed(self, request_id: str, additional_attempts: int) -> None:
        """Grant a failed request more attempts, due now."""
        r = self.get(request_id)
        if r is None or r.status != "FAILED" or additional_attempts < 1:
            raise QueueError("only a failed request can be given more attempts")
        r.status, r.completed_at_utc, r.max_attempts, r.next_attempt_at_utc = "PENDING", None, r.max_attempts + additional_attempts, _text(self.clock())
        self._save(r)


class Worker:
    """Claims a request, builds a result as of its cutoff, publishes it and completes the request."""

    def __init__(
        self, queue: Queue, store, build: Callable, hook: Callable[[str], None] = lambda point: None,
        owner: str = "worker"
    ):
        self.queue, self.store, self.build, self.hook, self.owner = queue, store, build, hook, owner

    def run_next(self) -> str | None:
        """The run id that was published, or None if nothing is due.  A failure is recorded and raised."""
        r = self.queue.claim_next(self.owner)
        if r is None:
            return None
        # Each claim has a run id of its own, so no claim writes over what another has published.
        first = f"run-{r.request_id[:12]}-"
        run_id = f"{first}{r.attempt_count + 1}" + (f"-{r.generation}" if r.generation else "")
        done = next((x for x in self.store.runs() if x.startswith(first)), None)
        if done:
            # A worker died after its result became current: the work is done and only the request is open.
            self.queue.mark_succeeded(r.request_id, done)
            return done
        try:
            self.hook("after_claim")
            result = self.build(run_id, _time(r.as_of_utc))
            self.hook("after_build")
            self.store.publish(
                result, run_id, before_commit=lambda _: self._before_commit(r), hook=self.hook,
                observed_at=_time(r.as_of_utc)
            )
            self.hook("after_pointer")
            self.hook("before_complete")
            self.queue.mark_succeeded(r.request_id, run_id)
        except Exception as error:
            if run_id in self.store.runs():
                # The pointer has moved: the work is done and must not be repeated.
                self.queue.mark_succeeded(r.request_id, run_id)
                return run_id
            self.queue.record_failure(r.request_id, error)
            raise
        self.hook("after_commit")
        return run_id

    def _before_commit(self, r: Request) -> None:
        self.hook("before_pointer")
        if self.queue.overtaken(r):
            raise QueueError("the lease ran out and another worker holds the request")


def drain(
    worker: Worker, *, max_requests: int = 10, max_seconds: float = 300.0, clock: Callable[[], float] = time.monotonic
) -> dict:
    """Run due requests until none is due or a bound is met."""
    if max_requests < 1 or max_seconds <= 0:
        raise ValueError("bounds must be positive")
    began, runs, failed = clock(), [], 0
    while len(runs) + failed < max_requests:
        if clock() - began >= max_seconds:
            return {"runs": runs, "failed": failed, "stopped": "TIME"}
        try:
            run = worker.run_next()
        except Exception:  # noqa: BLE001  recorded by the worker; the next request may be sound
            failed += 1
            continue
        if run is None:
            return {"runs": runs, "failed": failed, "stopped": "EMPTY"}
        runs.append(run)
    return {"runs": runs, "failed": failed, "stopped": "REQUESTS"}
