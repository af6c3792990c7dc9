"""Which folders of files each table of a dataset consists of, version by version.

A version is one small JSON file, `manifest-<number>.json`, written under another name and
then renamed. It names all folders of all tables, so a reader opens the newest one and
sees every table as one load left it; what a load wrote without getting as far as its
manifest is never seen. Older versions stay readable.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

_NAME = "manifest-{:012d}.json"


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    # Folders by table, relative to the table's own folder.
    tables: dict[str, list[str]] = field(default_factory=dict)
    # The last micro-batch that went in, by stream.
    batches: dict[str, int] = field(default_factory=dict)

    def after(self, added: dict[str, list[str]], replaced: dict[str, list[str]], batches: dict[str, int]) -> Manifest:
        """The next version: folders added to some tables, others put in place of what they had."""
        tables = {name: list(folders) for name, folders in self.tables.items()} | replaced
        for name, folders in added.items():
            tables[name] = tables.get(name, []) + folders
        return replace(self, number=self.number + 1, tables=tables, batches=self.batches | batches)


class Files:
    """A session's file systems, as Spark itself would resolve a path."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _find(self, path: str):
        found = self._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self._conf), found

    def exists(self, path: str) -> bool:
        files, found = self._find(path)
        return files.exists(found)

    def names(self, path: str) -> list[str]:
        """Names in a folder; none when it is not there."""
        files, found = self._find(path)
        return [s.getPath().getName() for s in files.listStatus(found)] if files.exists(found) else []

    def size(self, path: str) -> int:
        """Bytes below a folder; zero when it is not there."""
        files, found = self._find(path)
        return files.getContentSummary(found).getLength() if files.exists(found) else 0

    def delete(self, path: str) -> bool:
        files, found = self._find(path)
        return files.delete(found, True)

    def read(self, path: str) -> str:
        files, found = self._find(path)
        stream = files.open(found)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> None:
        """A file that is there whole or not at all; an existing one is an error."""
        files, found = self._find(path)
        part = self._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
        stream = files.create(part, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if files.exists(found) or not files.rename(part, found):
            files.delete(part, False)
            raise FileExistsError(path)


class ManifestLog:
    def __init__(self, spark: SparkSession, root: str):
        self.folder, self.files = f"{root}/_manifests", Files(spark)

    def numbers(self) -> list[int]:
        names = self.files.names(self.folder)
        return sorted(int(n[len("manifest-") : -len(".json")]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def read(self, number: int | None = None) -> Manifest:
        """The newest version, or one by its number; an empty one before the first."""
        if number is None:
            number = max(self.numbers(), default=0)
        if number == 0:
            return Manifest()
        return Manifest(**json.loads(self.files.read(f"{self.folder}/{_NAME.format(number)}")))

    def write(self, manifest: Manifest) -> Manifest:
        """Fails when another writer has published this number in the meantime."""
        body = {"number": manifest.number, "tables": manifest.tables, "batches": manifest.batches}
        self.files.write_new(f"{self.folder}/{_NAME.format(manifest.number)}", json.dumps(body))
        return manifest
