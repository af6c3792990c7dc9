"""A type 2 history as two published tables: open versions and closed ones.

A snapshot meets the open versions only. What it closes is appended to the closed ones, which
are never read or written again by it; the open ones are replaced. Both change in one
version, which also notes the snapshot's day.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillhouse.operators.history import VALID, next_versions
from tillhouse.schemas import Table
from tillhouse.sinks.warehouse import Warehouse


@dataclass(frozen=True)
class HistoryTable:
    """History of `tracked` columns (text) by `keys` (text), under a name of its own in a dataset."""

    store: Warehouse
    name: str
    keys: tuple[str, ...]
    tracked: tuple[str, ...]

    def _table(self, part: str) -> Table:
        columns = [f"{c} string" for c in (*self.keys, *self.tracked)] + ["valid_from date", "valid_to date", "is_current boolean"]
        return Table(f"{self.name}_{part}", self.keys, "\n".join(columns))

    @property
    def opened(self) -> Table:
        return self._table("open")

    @property
    def closed(self) -> Table:
        return self._table("closed")

    def apply(self, snapshot: DataFrame, day: dt.date) -> bool:
        """Takes a snapshot in and returns whether it was new. Snapshots go in by day; an earlier or
        equal day has been in before and changes nothing."""
        store, stream = self.store, f"history:{self.name}"
        if store.manifest().batches.get(stream, -1) >= day.toordinal():
            return False
        staged = store.stage(f"{self.name}_versions", next_versions(store.read(self.opened), snapshot, list(self.keys), list(self.tracked), day))
        ended = store.write_plain(self.closed, staged.where(~staged.is_current))
        current = store.write_plain(self.opened, staged.where(staged.is_current))
        store.publish(ended, replaced=[current], batches={stream: day.toordinal()})
        return True

    def read(self, version: int | None = None) -> DataFrame:
        columns = [*self.keys, *self.tracked, *VALID]
        parts = [self.store.read(t, version).select(*columns) for t in (self.closed, self.opened)]
        return parts[0].unionByName(parts[1])
