"""Registration of tables in a catalog."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


class StatementFailed(RuntimeError):
    """A statement that failed or was cancelled."""


class StatementTimeout(StatementFailed):
    """A statement that did not end in time."""


class Catalog(Protocol):
    def register(self, name: str, path: str) -> None: ...

    def refresh(self, name: str) -> None: ...


def _quoted(name: str) -> str:
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


class StatementCatalog:
    """A catalog behind a statement service. ``send`` takes a SQL text and returns its state and, if any, an error."""

    def __init__(self, send: Callable[[str], tuple[str, str | None]]) -> None:
        self.send = send

    def _run(self, sql: str) -> None:
        state, error = self.send(sql)
        if state == "SUCCEEDED":
            return
        raise StatementFailed(f"{state}: {error or sql}") if state in ("FAILED", "CANCELED") else StatementTimeout(f"{state}: {sql}")

    def register(self, name: str, path: str) -> None:
        self._run(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} USING DELTA LOCATION '{path.replace(chr(39), chr(39) * 2)}'")

    def refresh(self, name: str) -> None:
        self._run(f"MSCK REPAIR TABLE {_quoted(name)} SYNC METADATA")


class SessionCatalog:
    """Temporary views of the session over tables' latest snapshots."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def register(self, name: str, path: str) -> None:
        self.paths[name] = path
        self.refresh(name)

    def refresh(self, name: str) -> None:
        from .table import Table

        Table(self.spark, self.paths[name]).read().createOrReplaceTempView(name.replace(".", "_"))


class CatalogSync:
    """Registers each table once and refreshes it at most every ``interval`` seconds; failures are logged only."""

    def __init__(self, catalog: Catalog, interval: float = 300.0, clock: Callable[[], float] = time.monotonic) -> None:
        self.catalog, self.interval, self.clock = catalog, interval, clock
        self._last: dict[str, float] = {}

    def committed(self, name: str, path: str) -> None:
        now = self.clock()
        try:
            if name not in self._last:
                self.catalog.register(name, path)
            elif now - self._last[name] >= self.interval:
                self.catalog.refresh(name)
            else:
                return
            self._last[name] = now
        except Exception as e:
            log.warning("catalog of %s: %s", name, e)
