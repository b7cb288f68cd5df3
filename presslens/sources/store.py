"""The curated store on Parquet: append, upsert, insert-if-absent, fill-only enrichment, provenance, retention.

Plain Parquet has no merge, so rows lie in parts that never change, and a version is a list of parts: an update writes a
new part beside the old ones and then a new list. Readers see the whole old or the whole new state, and an addition costs
what it adds. Each function also exists as a pure DataFrame transformation, which the
queries use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of both; for one key the new row, of several new ones the one latest in ``order``."""
    last = new.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).where("__r = 1").drop("__r")
    return old.join(last.select(*keys), keys, "left_anti").unionByName(last.select(*old.columns))


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose key is not stored yet, each once."""
    return new.join(old.select(*keys), keys, "left_anti").dropDuplicates(keys)


def fill_only(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Old rows whose empty fields take the new values; what is set stays."""
    fresh = new.groupBy(key).agg(*(F.min(F.nullif(F.col(f), F.lit(""))).alias(f"__{f}") for f in fields))
    return old.join(fresh, key, "left").select(*(F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"__{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in old.columns))


def add_provenance(old: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Old rows whose ``also_routes`` got the ways by which they were delivered again, each once and in order."""
    more = seen.groupBy(key).agg(F.array_sort(F.collect_set("via")).alias("__via"))
    return old.join(more, key, "left").withColumn("also_routes", F.array_distinct(F.concat(F.coalesce("also_routes", F.array().cast("array<string>")), F.coalesce("__via", F.array().cast("array<string>"))))).drop("__via")


def retain(ledger: DataFrame, runs: DataFrame, keep_days: int, current_run: int | None = None) -> DataFrame:
    """Ledger rows that survive: by the runs' own clock, the current run always."""
    if keep_days <= 0:
        return ledger
    old = runs.join(F.broadcast(runs.agg(F.max("started_at").alias("last")))).where(F.col("started_at") < F.col("last") - F.make_dt_interval(F.lit(keep_days))).select(F.col("id").alias("run_id"))
    if current_run is not None:
        old = old.where(F.col("run_id") != current_run)
    return ledger.join(old, "run_id", "left_anti")


class Store:
    """Versioned Parquet tables in one folder; a version, a list of immutable parts, is complete before it becomes current."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, name: str, letter: str, complete: bool) -> list[int]:
        root = self._path(f"{self.folder}/{name}")
        if not self._fs.exists(root):
            return []
        found = [s.getPath() for s in self._fs.listStatus(root) if s.getPath().getName().startswith(letter)]
        return sorted(int(x.getName()[1:]) for x in found if not complete or self._fs.exists(self._path(x, "_SUCCESS")))

    def versions(self, name: str) -> list[int]:
        """Complete versions of a table, ascending."""
        return self._numbers(name, "v", True)

    def parts(self, name: str, version: int) -> list[int]:
        """Numbers of the parts of a version."""
        return sorted(int(r[0]) for r in self.spark.read.text(f"{self.folder}/{name}/v{version}").collect())

    def read(self, name: str) -> DataFrame | None:
        """Current version, None before the first."""
        v = self.versions(name)
        return self.spark.read.parquet(*(f"{self.folder}/{name}/p{k}" for k in self.parts(name, v[-1]))) if v else None

    def _publish(self, name: str, rows: DataFrame, old: list[int], keep: int) -> None:
        part = max(self._numbers(name, "p", False), default=0) + 1
        rows.write.mode("overwrite").parquet(f"{self.folder}/{name}/p{part}")
        v = self.versions(name)
        # one list of a few numbers; its _SUCCESS file makes it the current version
        self.spark.createDataFrame([(str(k),) for k in [*old, part]], "k string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/{name}/v{v[-1] + 1 if v else 1}")
        gone = v[: max(0, len(v) + 1 - keep)]
        for x in gone:
            self._fs.delete(self._path(f"{self.folder}/{name}/v{x}"), True)
        live = {k for x in self.versions(name) for k in self.parts(name, x)}
        for k in self._numbers(name, "p", True):
            if k not in live and gone:
                self._fs.delete(self._path(f"{self.folder}/{name}/p{k}"), True)

    def write(self, name: str, rows: DataFrame, keep: int = 2) -> None:
        """Make ``rows`` the current version; all but the last ``keep`` versions go, with the parts that only they had."""
        self._publish(name, rows, [], keep)

    def append(self, name: str, rows: DataFrame, keep: int = 2) -> None:
        """A new version with the rows of the current one and these."""
        v = self.versions(name)
        self._publish(name, rows, self.parts(name, v[-1]) if v else [], keep)

    def compact(self, name: str, files: int, most_parts: int = 1) -> None:
        """Rewrite the current version into one part of fewer files once it has more than ``most_parts`` parts."""
        v = self.versions(name)
        if v and len(self.parts(name, v[-1])) >= most_parts:
            self.write(name, self.read(name).coalesce(files))
