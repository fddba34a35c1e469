"""Counters of the sink, by topic."""

from __future__ import annotations

import threading
import time
from collections import defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager

#: The metrics' names.
NAMES = (
    "records.received", "records.converted", "records.dlq", "records.flushed", "flush.latency", "commit.version",
    "merge.inserted", "merge.updated", "merge.deleted", "merge.files.rewritten", "merge.files.skipped", "schema.evolutions",
)


class Metrics:
    """Counters, a gauge (commit.version) and a timer (flush.latency, in seconds). ``export`` gets each change."""

    def __init__(self, export: Callable[[str, str, float], None] | None = None) -> None:
        self.values: dict[tuple[str, str], float] = defaultdict(float)
        self._lock, self._export = threading.Lock(), export

    def _set(self, name: str, topic: str, value: float, add: bool) -> None:
        if name not in NAMES:
            raise KeyError(name)
        with self._lock:
            self.values[name, topic] = self.values[name, topic] + value if add else value
            now = self.values[name, topic]
        if self._export:
            try:
                self._export(name, topic, now)
            except Exception:  # an exporter must not stop ingestion
                self._export = None

    def count(self, name: str, topic: str, n: float = 1) -> None:
        self._set(name, topic, n, True)

    def gauge(self, name: str, topic: str, value: float) -> None:
        self._set(name, topic, value, False)

    def get(self, name: str, topic: str) -> float:
        return self.values.get((name, topic), 0.0)

    @contextmanager
    def timed(self, name: str, topic: str) -> Iterator[None]:
        began = time.monotonic()
        try:
            yield
        finally:
            self.count(name, topic, time.monotonic() - began)
