"""Versioned tables under one folder: loads add rows and become visible together, by one commit.

Data folders are written once and never changed. A version is a numbered manifest that lists the data folders of every
table; the newest manifest counts. A commit puts the next manifest in place by a rename that fails if another
writer was faster, so that a lost writer, or one that comes second, leaves the version as it was (and data folders that no manifest
names). Works on any file system that Hadoop's FileContext reaches and whose rename is atomic.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from latewatch.operators import quality
from latewatch.schema import Table


class Overtaken(Exception):
    """Another writer has committed the version that was to be written."""


@dataclass(frozen=True)
class Version:
    """``folders`` of each table, in the order of their loads."""

    number: int = 0
    folders: Mapping[str, Sequence[str]] = field(default_factory=dict)


class Store:
    """Tables under ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._manifests = f"{self.folder}/manifests"

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self):
        path = self._path(self._manifests)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def current(self) -> Version:
        """The newest committed version."""
        files, path = self._files(), self._path(self._manifests)
        names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "."]
        if not numbers:
            return Version()
        text = self.spark.read.text(f"{self._manifests}/{max(numbers):012d}.json", wholetext=True).first().value
        found = json.loads(text)
        return Version(found["number"], found["folders"])

    def table(self, table: Table, version: Version | None = None) -> DataFrame:
        """All rows of a table in a version (the newest one by default)."""
        folders = (version or self.current()).folders.get(table.name, ())
        if not folders:
            return self.spark.createDataFrame([], table.schema)
        return self.spark.read.schema(table.schema).parquet(*[f"{self.folder}/{f}" for f in folders])

    def write(self, table: Table, rows: DataFrame) -> str:
        """Rows as a data folder that no version names yet; returns its name."""
        name = f"data/{table.name}-{uuid.uuid4()}"
        rows.select(*table.columns).write.parquet(f"{self.folder}/{name}")
        return name

    def commit(self, base: Version, added: Mapping[str, str]) -> Version:
        """The version after ``base`` with one more data folder for some tables, or ``Overtaken``."""
        folders = {name: list(held) for name, held in base.folders.items()}
        for name, new in added.items():
            folders[name] = [*folders.get(name, ()), new]
        version = Version(base.number + 1, folders)
        context = self.spark.sparkContext
        jvm, files = context._jvm, self._files()
        files.mkdirs(self._path(self._manifests))
        hidden = self._path(f"{self._manifests}/.{uuid.uuid4()}.tmp")
        out = files.create(hidden, False)
        try:
            out.write(bytearray(json.dumps({"number": version.number, "folders": folders}).encode()))
        finally:
            out.close()
        place = self._path(f"{self._manifests}/{version.number:012d}.json")
        contexts = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), context._jsc.hadoopConfiguration())
        plain = context._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            contexts.rename(files.makeQualified(hidden), files.makeQualified(place), plain)
        except Exception as error:
            if files.exists(place):
                files.delete(hidden, False)
                raise Overtaken(f"version {version.number}") from error
            raise
        return version


def unstored(rows: DataFrame, stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet; of new rows with equal keys the first in the order of the other columns."""
    others = [c for c in rows.columns if c not in key]
    return quality.first_per_key(rows, key, others).join(stored.select(*key), list(key), "left_anti")


def load_new(
    store: Store,
    tables: Sequence[Table],
    frames: Callable[[Version], Mapping[str, DataFrame]] | Mapping[str, DataFrame],
    check: Callable[[Mapping[str, DataFrame], Mapping[str, DataFrame]], None] | None = None,
    tries: int = 5,
) -> dict[str, int]:
    """Add the rows whose keys are new to all tables, in one commit; rows whose key is stored are left out, as the first one wins.

    Rows without a required value are left out too. ``frames`` may depend on the version that is added to. ``check``
    sees the new and the stored rows of all tables before the commit and raises to refuse the load. A writer that is
    overtaken begins again from the newer version. Returns the rows added.
    """
    for _ in range(tries):
        base = store.current()
        given = frames(base) if callable(frames) else frames
        stored = {t.name: store.table(t, base) for t in tables}
        folders, counts, written = {}, {}, {}
        for table in tables:
            complete, _ = quality.split_required(given[table.name].select(*table.columns), [*table.primary_key, *table.required])
            folders[table.name] = store.write(table, unstored(complete, stored[table.name], table.primary_key))
            written[table.name] = store.spark.read.schema(table.schema).parquet(f"{store.folder}/{folders[table.name]}")
            counts[table.name] = written[table.name].count()
        if check:
            check(written, stored)
        added = {name: folder for name, folder in folders.items() if counts[name]}
        if not added:
            return counts
        try:
            store.commit(base, added)
            return counts
        except Overtaken:
            continue
    raise Overtaken(f"{tries} times")


def total_rows(store: Store, tables: Sequence[Table]) -> dict[str, int]:
    version = store.current()
    return {t.name: store.table(t, version).count() for t in tables}

