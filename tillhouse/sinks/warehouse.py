"""Parquet tables of one tenant's dataset, in a folder all executors share.

A table is what the newest manifest names: folders of files, one per load. Facts are
partitioned by business day within a load and sorted by restaurant within a file; a load adds a
folder, and its keys to the key index. A dimension refresh puts one folder in the place of
all there were, for all dimensions of the refresh in one manifest. Files are written first and the manifest
last, so a load or refresh that dies leaves nothing that a reader sees. One writer
per dataset at a time; a second one that publishes in between is noticed and stopped.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.operators.insert import not_in_target, one_per_key
from tillhouse.schemas import Table
from tillhouse.session import DROP_SHUFFLES, SIZE_IN_MEMORY, settings
from tillhouse.sinks.key_index import BUCKETS, COMPRESSION, KeyIndex
from tillhouse.sinks.manifest import Files, Manifest, ManifestLog


@dataclass
class LoadResult:
    rows_staged: int
    rows_inserted: int
    inserted: DataFrame | None = field(default=None, repr=False)

    @property
    def duplicates_skipped(self) -> int:
        return self.rows_staged - self.rows_inserted


@dataclass(frozen=True)
class Written:
    """Files of a load that no manifest names yet."""

    table: Table
    folder: str
    rows: int
    # Further folders of a batch that was written in parts.
    others: tuple[str, ...] = ()

    @property
    def folders(self) -> list[str]:
        return [self.folder, *self.others]


def _load_name() -> str:
    return f"load={dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}_{uuid.uuid4().hex[:8]}"


def _observed(seen: Observation) -> dict[str, int]:
    """What was observed; nothing of a plan that the optimizer found to be empty."""
    try:
        return {name: value or 0 for name, value in seen.get.items()}
    except Py4JJavaError:
        return {}


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, dataset: str, run: str | None = None, buckets: int = BUCKETS):
        self.spark = spark
        self.root = f"{root.rstrip('/')}/{dataset}"
        # Staged tables of one run share a folder.
        self.run = run or uuid.uuid4().hex
        self.buckets = buckets
        self.files = Files(spark)
        self.log = ManifestLog(spark, self.root)

    def path(self, table: Table | str) -> str:
        return f"{self.root}/{table if isinstance(table, str) else table.name}"

    def index(self, table: Table) -> KeyIndex:
        keys, units = self.path(f"{table.name}_keys"), self.path(f"{table.name}_key_units")
        return KeyIndex(self.spark, table.key, keys, units, self.buckets)

    # --- versions --------------------------------------------------------------

    def manifest(self, version: int | None = None) -> Manifest:
        return self.log.read(version)

    def publish(self, *added: Written, replaced: list[Written] = (), batches: dict[str, int] | None = None) -> Manifest:
        """Makes written files visible, all at once. Without anything to add the version stays."""
        more: dict[str, list[str]] = {}
        for w in added:
            if w.rows:
                more.setdefault(w.table.name, []).extend(w.folders)
        now = self.manifest()
        if not (more or replaced or batches):
            return now
        return self.log.write(now.after(more, {w.table.name: [w.folder] for w in replaced}, batches or {}))

    def _open(self, table: Table, folders: list[str], more: list[T.StructField] = ()) -> DataFrame:
        schema = T.StructType([*table.schema, *more])
        if not folders:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", self.path(table))
        return found.parquet(*[f"{self.path(table)}/{f}" for f in folders]).select(*schema.names)

    def read(self, table: Table, version: int | None = None) -> DataFrame:
        """A table as a version has it, else the newest; filters on a fact's `business_date` prune folders."""
        return self._open(table, self.manifest(version).tables.get(table.name, []))

    def unpublished(self, table: Table) -> list[str]:
        """Folders of files that no version names, as loads that died leave them."""
        named = {f for n in self.log.numbers() for f in self.log.read(n).tables.get(table.name, [])}
        return sorted(f for f in self.files.names(self.path(table)) if f.startswith("load=") and f not in named)

    def drop_unpublished(self, table: Table) -> int:
        """Deletes such folders with their keys. Call it when no load is under way."""
        index, gone = self.index(table), self.unpublished(table)
        for folder in gone:
            for root in (self.path(table), index.keys_root, index.units_root):
                self.files.delete(f"{root}/{folder}")
        return len(gone)

    # --- facts ---------------------------------------------------------------

    def write(self, table: Table, rows: DataFrame, more: list[str] = (), staged: bool = True) -> Written:
        """Writes rows and their keys as a load of its own, not visible yet.

        Rebalancing gathers each day in few files; a day that is too large for one
        task is split again by adaptive execution. Columns named in `more` are in the files too, where
        readers of the table do not see them. Keys are taken from the rows, read a second time, or
        where these are not `staged` from the files.
        """
        folder, seen = _load_name(), Observation()
        laid_out = rows.select(*table.columns, *more).hint("rebalance", "business_date")
        ordered = laid_out.sortWithinPartitions("business_date", "restaurant_guid")
        counted = ordered.observe(seen, F.count(F.lit(1)).alias("n"))
        with settings(self.spark, DROP_SHUFFLES):
            counted.write.partitionBy("business_date").parquet(f"{self.path(table)}/{folder}", compression=COMPRESSION)
        n = _observed(seen).get("n", 0)
        if n:
            self.index(table).write(folder, rows if staged else self._open(table, [folder]))
        return Written(table, folder, n)

    def write_plain(self, table: Table, rows: DataFrame) -> Written:
        """Writes rows of a table without days and key index, not visible yet."""
        folder, seen = _load_name(), Observation()
        counted = rows.select(*table.columns).observe(seen, F.count(F.lit(1)).alias("n"))
        with settings(self.spark, DROP_SHUFFLES):
            counted.write.parquet(f"{self.path(table)}/{folder}")
        return Written(table, folder, _observed(seen).get("n", 0))

    def append(self, table: Table, rows: DataFrame) -> int:
        """Appends rows by column name and returns how many were written."""
        written = self.write(table, rows)
        self.publish(written)
        return written.rows

    def known_keys(self, table: Table, batch: DataFrame, version: int | None = None) -> DataFrame | None:
        """Keys of a fact that the batch may hold, from the files of the index that may have them; None without any."""
        index = self.index(table)
        return index.read(index.holding(self.manifest(version).tables.get(table.name, []), batch), batch)

    def compact(self, table: Table) -> int:
        """Puts one load in the place of all loads of a fact, keys included, and returns its rows.

        Many small loads become few files per day and one unit per bucket; older versions keep theirs.
        """
        if len(self.manifest().tables.get(table.name, [])) < 2:
            return 0
        written = self.write(table, self.read(table))
        self.publish(replaced=[written])
        return written.rows

    # --- staging ---------------------------------------------------------------

    def stage(self, name: str, rows: DataFrame) -> DataFrame:
        """Writes rows under a fresh name and reads them back.

        The staged table cuts lineage: checks, key counts and the insert read
        columns from it and never parse the documents again.
        """
        return self.stage_counted(name, rows)[0]

    def stage_counted(self, name: str, rows: DataFrame, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
        """A staged table and what was counted while it was written."""
        path = f"{self.root}/_staging/{self.run}/{name}_{uuid.uuid4().hex}"
        seen = Observation()
        if counts:
            rows = rows.observe(seen, *[c.alias(n) for n, c in counts.items()])
        with settings(self.spark, DROP_SHUFFLES):
            rows.write.parquet(path, compression=COMPRESSION)
        found = dict.fromkeys(counts, 0) | (_observed(seen) if counts else {})
        return self.spark.read.schema(rows.schema).parquet(path), found

    def drop_staging(self, run: str | None = None) -> bool:
        """Deletes the staged tables of a finished run, or of all runs, whose frames then end too."""
        return self.files.delete(f"{self.root}/_staging" + (f"/{run}" if run else ""))

    def prepare(self, table: Table, staged: DataFrame, dedup_batch: bool = False, hot_rows: int = 0, n_staged: int | None = None) -> tuple[Written | None, LoadResult]:
        """Writes the staged rows whose key is new, not visible yet. An empty batch writes nothing.

        `staged` is a staged table or a plain part of one. What was inserted is read from the
        written files, which also hold the batch's columns that the table has not. Where the index knows no
        key of the batch, all of it is new and nothing is joined. A very large batch is taken bucket by bucket of its keys.
        """
        keys = list(table.key)
        n_staged = staged.count() if n_staged is None else n_staged
        if not n_staged:
            return None, LoadResult(0, 0, staged)
        index = self.index(table)
        units = index.holding(self.manifest().tables.get(table.name, []), staged, n_staged)
        if not units and not dedup_batch:
            written = self.write(table, staged)
            return written, LoadResult(n_staged, written.rows, staged)
        more, parts = [f for f in staged.schema if f.name not in table.columns], []
        for buckets in index.rounds(n_staged):
            batch = index.of_buckets(staged, buckets)
            batch = one_per_key(batch, keys) if dedup_batch else batch
            known = index.read({(load, bucket) for load, bucket in units if bucket in buckets}, staged)
            if known is not None:
                batch = not_in_target(batch, known, keys, None if dedup_batch else hot_rows)
            with settings(self.spark, SIZE_IN_MEMORY):
                parts.append(self.write(table, batch, [f.name for f in more], staged=False))
        filled = [w for w in parts if w.rows] or parts[:1]
        written = Written(table, filled[0].folder, sum(w.rows for w in filled), tuple(w.folder for w in filled[1:]))
        return written, LoadResult(n_staged, written.rows, self._open(table, written.folders, more))

    def insert_new(self, table: Table, staged: DataFrame, dedup_batch: bool = False, hot_rows: int = 0, n_staged: int | None = None) -> LoadResult:
        """Appends the staged rows whose key is new."""
        written, result = self.prepare(table, staged, dedup_batch, hot_rows, n_staged)
        if written:
            self.publish(written)
        return result

    # --- dimensions ----------------------------------------------------------

    def read_dimension(self, table: Table, version: int | None = None) -> DataFrame:
        return self.read(table, version)

    def write_dimension(self, table: Table, rows: DataFrame, mode: str = "full") -> Written:
        """Writes a dimension's next content, not visible yet. `rows` are read once, or twice by restaurant.

        `full` replaces the whole table, `restaurant` only the restaurants that are
        in `rows`. The result counts what came from `rows`; zero means that the table stays.
        """
        if mode not in ("full", "restaurant"):
            raise ValueError(f"unknown refresh mode {mode!r}")
        folder, seen = _load_name(), Observation()
        content = rows.select(*table.columns).observe(seen, F.count(F.lit(1)).alias("n"))
        if mode == "restaurant":
            renewed = rows.select("restaurant_guid").distinct()
            kept = self.read(table).join(renewed, "restaurant_guid", "left_anti")
            content = content.unionByName(kept.select(*table.columns))
        laid_out = content.hint("rebalance").sortWithinPartitions("restaurant_guid")
        with settings(self.spark, DROP_SHUFFLES):
            laid_out.write.parquet(f"{self.path(table)}/{folder}")
        return Written(table, folder, _observed(seen).get("n", 0))

    def refresh_all(self, rows: dict[Table, DataFrame], mode: str = "full") -> dict[str, int]:
        """Replaces several dimensions in one version; without rows a table stays as it was."""
        written = [self.write_dimension(table, content, mode) for table, content in rows.items()]
        self.publish(replaced=[w for w in written if w.rows])
        return {w.table.name: w.rows for w in written}

    def refresh(self, table: Table, rows: DataFrame, mode: str = "full") -> int:
        """Replaces one dimension and returns its number of rows read from `rows`."""
        return self.refresh_all({table: rows}, mode)[table.name]


def write_ndjson(rows: DataFrame, path: str) -> None:
    """One JSON object per line; timestamps keep their microseconds."""
    rows.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
