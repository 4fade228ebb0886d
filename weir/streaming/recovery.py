"""Checkpointed queries and restart policies."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def checkpointed(
    writer: DataStreamWriter, location: str, interval: str | None = None
) -> DataStreamWriter:
    """Keep progress and state under ``location`` and commit every ``interval``, or
    once over the available input without one. The folder outlives the query, so
    starting again on it resumes."""
    writer = writer.option("checkpointLocation", location)
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


@dataclass
class FixedDelay:
    """At most ``attempts`` restarts, each after ``delay`` seconds."""

    attempts: int = 3
    delay: float = 10.0
    used: int = field(default=0, init=False)

    def next_delay(self, now: float) -> float | None:
        if self.used >= self.attempts:
            return None
        self.used += 1
        return self.delay


@dataclass
class FailureRate:
    """Give up at ``failures`` failures within ``interval`` seconds."""

    failures: int = 3
    interval: float = 30.0
    delay: float = 2.0
    seen: list[float] = field(default_factory=list, init=False)

    def next_delay(self, now: float) -> float | None:
        self.seen = [t for t in self.seen if now - t < self.interval]
        self.seen.append(now)
        return None if len(self.seen) >= self.failures else self.delay


def run_with_restarts(
    start: Callable[[], StreamingQuery],
    policy: FixedDelay | FailureRate,
    sleep: Callable[[float], None] = time.sleep,
    clock: Callable[[], float] = time.monotonic,
) -> int:
    """Start the query and wait for its end, restarting it after failures as the
    policy allows; returns the number of restarts. ``start`` must use a fixed
    checkpoint location. The last failure is raised when the policy gives up."""
    restarts = 0
    while True:
        try:
            start().awaitTermination()
            return restarts
        except StreamingQueryException:
            delay = policy.next_delay(clock())
            if delay is None:
                raise
            restarts += 1
            sleep(delay)
