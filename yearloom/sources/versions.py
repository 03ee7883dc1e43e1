"""A table in versions: a manifest says which folders hold it, and a change writes only the partitions that it touches.

folder/data/commit=C/by=value/ holds the files of a commit, folder/versions/N.json the manifest of version N: for each
value of the partition column the commit that has its rows.  A change writes the partitions it touches under a new commit,
then the next manifest beside the others and renames it, which is the one step that makes it hold.  Files are never
rewritten, so whoever reads an older version goes on, and a run that fails leaves a commit that no manifest names.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import storage

#: What a null partition value is called in manifests; Spark names its folder so too (a fixed value).
NULL = "__HIVE_DEFAULT_PARTITION__"


class Conflict(Exception):
    """Another change came first."""


class Versioned:
    """A table whose rows are partitioned by one column of numbers or short texts (a year)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @staticmethod
    def create(df: DataFrame, folder: str, by: str = "year") -> "Versioned":
        table = Versioned(df.sparkSession, folder)
        if table.versions():
            raise Conflict(f"{folder} is a table already")
        table._commit({"by": by, "schema": df.schema.json(), "parts": table._write(df, by)}, -1)
        return table

    def versions(self) -> list[int]:
        path, store = storage.path_of(self.spark, f"{self.folder}/versions")
        if not store.exists(path):
            return []
        names = [x.getPath().getName() for x in store.listStatus(path)]
        return sorted(int(x.removesuffix(".json")) for x in names if x.endswith(".json") and not x.startswith("_"))

    def manifest(self, version: int | None = None) -> dict:
        """by, schema and parts {value: commit} of a version, the last one unless said otherwise; and its number."""
        version = self.versions()[-1] if version is None else version
        text = self.spark.read.option("wholetext", True).text(f"{self.folder}/versions/{version}.json").first()["value"]
        return json.loads(text) | {"version": version}

    def read(self, version: int | None = None, manifest: dict | None = None, only: list[str] | None = None) -> DataFrame:
        """The rows of a version; a filter on the partition column prunes its folders."""
        from pyspark.sql.types import StructType

        told = manifest or self.manifest(version)
        schema, by = StructType.fromJson(json.loads(told["schema"])), told["by"]
        folders = [self._folder(by, value, commit) for value, commit in sorted(told["parts"].items()) if only is None or value in only]
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(StructType([*schema.fields]).add("commit", "string")).option("basePath", f"{self.folder}/data").parquet(*folders)
        return rows.select(*schema.names)

    def _folder(self, by: str, value: str, commit: str) -> str:
        return f"{self.folder}/data/commit={commit}/{by}={value}"

    def _write(self, df: DataFrame, by: str) -> dict[str, str]:
        """Rows as a new commit: {value: commit} of the partitions they are in."""
        commit = uuid4().hex
        at = f"{self.folder}/data/commit={commit}"
        # A large partition is split over tasks and files by its size.
        df.hint("rebalance", by).write.partitionBy(by).parquet(at)
        path, store = storage.path_of(self.spark, at)
        names = [x.getPath().getName() for x in store.listStatus(path)]
        return {x.split("=", 1)[1]: commit for x in names if x.startswith(f"{by}=")}

    def _commit(self, manifest: dict, base: int) -> int:
        told = json.dumps({k: manifest[k] for k in ("by", "schema", "parts")}, sort_keys=True)
        version = base + 1
        beside, store = storage.path_of(self.spark, f"{self.folder}/versions/_{uuid4().hex}")
        out = store.create(beside)
        out.write(told.encode())
        out.close()
        final = storage.path_of(self.spark, f"{self.folder}/versions/{version}.json")[0]
        if store.exists(final) or not store.rename(beside, final):
            store.delete(beside, False)
            raise Conflict(f"version {version} of {self.folder} exists")
        return version

    def delete(self, values: list) -> int:
        """Without these partitions; nothing is written but a manifest.  Gives the new version."""
        told = self.manifest()
        gone = {NULL if v is None else str(v) for v in values}
        parts = {v: c for v, c in told["parts"].items() if v not in gone}
        return self._commit(told | {"parts": parts}, told["version"])

    def replace(self, df: DataFrame) -> int:
        """With df's rows in place of those of its partitions."""
        told = self.manifest()
        return self._commit(told | {"parts": told["parts"] | self._write(df, told["by"])}, told["version"])

    def update(self, where: Column, changes: dict[str, Column]) -> int:
        """With columns changed in the rows that a condition holds for; only their partitions are written.  The partition
        column can't be changed."""
        told = self.manifest()
        by = told["by"]
        if by in changes:
            raise ValueError(f"{by} says where a row lies")
        rows = self.read(manifest=told)
        # A value for each partition at most.
        touched = [NULL if r[0] is None else str(r[0]) for r in rows.where(where).select(by).distinct().collect()]
        if not touched:
            return told["version"]
        part = self.read(manifest=told, only=touched)
        part = part.withColumns({c: F.when(where, x).otherwise(F.col(c)) for c, x in changes.items()})
        return self._commit(told | {"parts": told["parts"] | self._write(part, by)}, told["version"])

    def files(self, version: int | None = None) -> set[str]:
        """The files of a version."""
        told, out = self.manifest(version), set()
        for value, commit in told["parts"].items():
            path, store = storage.path_of(self.spark, self._folder(told["by"], value, commit))
            out |= {x.getPath().toString() for x in store.listStatus(path) if x.getPath().getName().startswith("part-")}
        return out

    def clear(self, keep: int = 1) -> None:
        """Drops all but the last versions, and commits that none of those has."""
        versions = self.versions()
        live = {c for v in versions[-keep:] for c in self.manifest(v)["parts"].values()}
        for v in versions[:-keep]:
            storage.drop_folder(self.spark, f"{self.folder}/versions/{v}.json")
        path, store = storage.path_of(self.spark, f"{self.folder}/data")
        for x in store.listStatus(path):
            if x.getPath().getName().removeprefix("commit=") not in live:
                store.delete(x.getPath(), True)
