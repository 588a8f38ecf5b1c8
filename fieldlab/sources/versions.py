"""Stored tables that may be made from themselves: versions beside each other, and a pointer that is swapped after a check.

A table at ``root`` has its versions in ``root/_versions/<name>`` and the current one's name in ``root/_pointer``. A write makes a new
version, counts its rows against the rows that went in, and then replaces the pointer by a rename. So

* the table that a frame reads is never touched while the frame is written over it;
* readers see the old version or the new one, never half a table; frames made before a swap go on with the version they began with;
* a write that fails, or whose check does, leaves the pointer and removes its own version.

A writer that finds the pointer moved since it looked gives up (``StaleTable``). Plain Parquet files in ``root`` count as the first
version. Versions stay until ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldlab.operators.maintain import append_unique, delete_where, update_where

_POINTER, _VERSIONS = "_pointer", "_versions"
#: The version that plain files of the folder are.
PLAIN = ""


class StaleTable(RuntimeError):
    """Somebody else replaced the table meanwhile."""


class FailedCheck(ValueError):
    """What was written is not what went in."""


class StoredTable:
    """A versioned table of one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _path(self, *parts: str):
        return self._fs.Path("/".join([self.root, *parts]))

    def _pointed(self) -> dict | None:
        path = self._path(_POINTER)
        system = path.getFileSystem(self._conf)
        if not system.exists(path):
            return None
        stream = system.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _point(self, told: dict) -> None:
        """Replace the pointer: a new file beside it takes its place by a rename."""
        fresh = self._path(f"{_POINTER}.{uuid.uuid4().hex}")
        system = fresh.getFileSystem(self._conf)
        stream = system.create(fresh, False)
        stream.write(bytearray(json.dumps(told).encode()))
        stream.close()
        rename = getattr(self.spark._jvm, "org.apache.hadoop.fs.Options$Rename")
        ways = self.spark.sparkContext._gateway.new_array(rename, 1)
        ways[0] = rename.OVERWRITE
        self._fs.FileContext.getFileContext(system.getUri(), self._conf).rename(fresh, self._path(_POINTER), ways)

    @property
    def version(self) -> str | None:
        """Name of the current version, None if there is no table."""
        told = self._pointed()
        if told is not None:
            return told["version"]
        root = self._path()
        system = root.getFileSystem(self._conf)
        plain = system.exists(root) and any(not s.getPath().getName().startswith(("_", ".")) for s in system.listStatus(root))
        return PLAIN if plain else None

    def history(self) -> list[str]:
        """Names of the versions that are kept, the current one last."""
        told = self._pointed()
        return [*told["before"], told["version"]] if told else [v for v in [self.version] if v is not None]

    def read(self, version: str | None = None) -> DataFrame:
        """The current version, or an older one that is kept."""
        version = self.version if version is None else version
        if version is None:
            raise FileNotFoundError(f"no table at {self.root}")
        return self.spark.read.parquet(self.root if version == PLAIN else f"{self.root}/{_VERSIONS}/{version}")

    def replace(
        self, df: DataFrame, partition_by: list[str] = (), check: Callable[[DataFrame], bool] | None = None, since: str | None = None
    ) -> StoredTable:
        """Make the rows of a frame, which may read this table, the current version.

        ``check`` gets the written table and may refuse it. ``since`` is the version that the frame was made from, if it is
        not the current one of this moment.
        """
        before = self.version if since is None else since
        name = uuid.uuid4().hex
        path = self._path(_VERSIONS, name)
        seen = Observation()
        try:
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy(*partition_by).parquet(f"{self.root}/{_VERSIONS}/{name}")
            stored = self.spark.read.schema(df.schema).parquet(f"{self.root}/{_VERSIONS}/{name}")
            rows = stored.count()
            if rows != seen.get["rows"]:
                raise FailedCheck(f"{rows} rows are stored of {seen.get['rows']}")
            if check is not None and not check(stored):
                raise FailedCheck("the check refused the written table")
            if self.version != before:
                raise StaleTable(f"{self.root} was replaced meanwhile")
            self._point({"version": name, "rows": rows, "before": self.history()})
        except BaseException:
            path.getFileSystem(self._conf).delete(path, True)
            raise
        return self

    def update_where(self, predicate: Column, values: dict[str, Column]) -> StoredTable:
        """Set columns where the predicate is true and store the table."""
        return self._changed(lambda df: update_where(df, predicate, values))

    def delete_where(self, predicate: Column) -> StoredTable:
        """Drop rows for which the predicate is true and store the table."""
        return self._changed(lambda df: delete_where(df, predicate))

    def append(self, batch: DataFrame, keys: list[str] | None = None) -> StoredTable:
        """Add rows; with ``keys`` the whole batch is refused on any conflict."""
        return self._changed(lambda df: append_unique(df, batch, keys) if keys else df.unionByName(batch, allowMissingColumns=True))

    def _changed(self, change: Callable[[DataFrame], DataFrame]) -> StoredTable:
        now = self.version
        return self.replace(change(self.read(now)), since=now)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove all but the last ``keep`` versions; their names. Frames that still read them fail."""
        told = self._pointed()
        if told is None:
            return []
        versions = [*told["before"], told["version"]]
        gone, left = versions[: max(0, len(versions) - max(1, keep))], versions[max(0, len(versions) - max(1, keep)) :]
        self._point({**told, "before": left[:-1]})
        root = self._path()
        system = root.getFileSystem(self._conf)
        for name in gone:
            if name != PLAIN:
                system.delete(self._path(_VERSIONS, name), True)
                continue
            for status in system.listStatus(root):
                if not status.getPath().getName().startswith(("_", ".")):
                    system.delete(status.getPath(), True)
        return gone


def stored(spark: SparkSession, root: str) -> DataFrame:
    """The current version of a table."""
    return StoredTable(spark, root).read()
