"""Tables that change all at once: folders that are never changed, a manifest for each version, and
readers that are bound to one version.

``data/<table>/<run>-<attempt>`` holds what one attempt of a run wrote of one table.
``manifests/<version>.json`` names the folders of every table. A run writes its folders first, which
nobody sees; then its manifest is moved to the next number, which makes all of them visible
together. The move fails if the number is taken: of two runs that began with one version the second
takes up the first one's tables, and is refused if both replaced the same table. A run that fails
leaves the last version as it was, and a reader of an older version keeps its rows until ``expire``.

A run's id is its commit key: when a run is repeated, after a failure or after its commit, what it
appended before is replaced by what it appends now.

Only names of folders and schemas pass the driver. The move is atomic where the file system's
rename is, as on HDFS; on a local disk only for one writer at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mercata.sources.files import Files


class Conflict(RuntimeError):
    """Another run replaced the same table since this run began."""


class Store:
    """The versions of a set of tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, root)

    def versions(self) -> list[int]:
        names = self.files.children(f"{self.root}/manifests")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def current(self) -> int:
        """The last version; 0 before the first commit."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.current() if version is None else version
        if not version:
            return {"version": 0, "run": None, "tables": {}}
        return json.loads(self.files.read(f"{self.root}/manifests/{version:012d}.json"))

    def tables(self, version: int | None = None) -> list[str]:
        return sorted(self.manifest(version)["tables"])

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """The rows of a table in one version, which later commits do not change."""
        tables = self.manifest(version)["tables"]
        if table not in tables:
            raise KeyError(f"no table {table!r} in {self.root}")
        return self.frame(tables[table])

    def frame(self, parts: list[dict]) -> DataFrame:
        frames = [self.spark.read.schema(StructType.fromJson(p["schema"])).parquet(f"{self.root}/{p['folder']}")
                  for p in parts]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def begin(self, run: str | None = None) -> Run:
        return Run(self, run or uuid.uuid4().hex)

    def expire(self, keep: int = 2, older_than: float = 86_400) -> list[str]:
        """Forget all but the last ``keep`` versions and delete the folders that only they had.
        Folders changed within ``older_than`` seconds stay, as an open run may be writing them."""
        versions = self.versions()
        kept = versions[-max(keep, 1):]
        used = {p["folder"] for v in kept for parts in self.manifest(v)["tables"].values() for p in parts}
        for v in versions[:-max(keep, 1)]:
            self.files.delete(f"{self.root}/manifests/{v:012d}.json")
        gone, before = [], (time.time() - older_than) * 1000

        def visit(folder: str) -> None:
            for name, changed in self.files.children(f"{self.root}/{folder}").items():
                inner = f"{folder}/{name}"
                if name.startswith(RUN):
                    if inner not in used and changed < before:
                        self.files.delete(f"{self.root}/{inner}")
                        gone.append(inner)
                else:
                    visit(inner)

        visit("data")
        return sorted(gone)


RUN = "run="


class Run:
    """Writes of one run, which become visible together when it commits."""

    def __init__(self, store: Store, run: str) -> None:
        if not run or "/" in run:
            raise ValueError("a run's id is a name without a slash")
        self.store, self.run, self.base = store, run, store.manifest()
        self.replaced: dict[str, list[dict]] = {}
        self.appended: dict[str, list[dict]] = {}

    def _written(self, table: str, df: DataFrame, partition_by: str | None) -> list[dict]:
        folder = f"data/{table}/{RUN}{self.run}-{uuid.uuid4().hex}"
        writer = df.hint("rebalance", F.col(partition_by)).write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(f"{self.store.root}/{folder}")
        return [{"run": self.run, "folder": folder, "schema": df.schema.jsonValue()}]

    def replace(self, table: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Write the rows a table will have, and return them as read again.

        With ``partition_by`` rows are rebalanced by that column first, so a partition is a few
        files of even size, and a value that holds much of the data is split over several tasks.
        """
        self.replaced[table] = self._written(table, df, partition_by)
        return self.store.frame(self.replaced[table])

    def append(self, table: str, df: DataFrame) -> DataFrame:
        """Write rows to be added to a table, and return these."""
        parts = self._written(table, df, None)
        self.appended[table] = self.appended.get(table, []) + parts
        return self.store.frame(parts)

    def _joined(self, now: dict) -> dict:
        old = self.base["tables"]
        lost = [t for t in self.replaced if now["tables"].get(t) != old.get(t)]
        if now["version"] != self.base["version"] and lost:
            raise Conflict(f"version {now['version']} replaced {', '.join(lost)} since {self.base['version']}")
        tables = {**now["tables"], **self.replaced}
        for table, parts in self.appended.items():
            tables[table] = [p for p in tables.get(table, []) if p["run"] != self.run] + parts
        return tables

    def commit(self) -> int:
        """Make all writes visible; the version they are in."""
        while True:
            now = self.store.manifest()
            version = now["version"] + 1
            text = json.dumps({"version": version, "run": self.run, "tables": self._joined(now)})
            if self.store.files.create(f"{self.store.root}/manifests/{version:012d}.json", text):
                return version
