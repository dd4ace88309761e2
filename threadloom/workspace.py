"""Named tables under one folder of any file system Spark reads. A table's state is its newest complete version: a save writes a
new one beside the old, so readers never see half a table and a failed job leaves the old state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KEEP = 2


class Workspace:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, name: str) -> list[int]:
        """Versions that Spark's committer has finished, oldest first."""
        fs, top = self._fs(), self._path(f"{self.root}/{name}")
        if not fs.exists(top):
            return []
        found = [s.getPath() for s in fs.listStatus(top)]
        return sorted(int(p.getName()) for p in found if p.getName().isdigit() and fs.exists(self._path(f"{p}/_SUCCESS")))

    def has(self, name: str) -> bool:
        return bool(self.versions(name))

    def table(self, name: str, like: str | None = None) -> DataFrame:
        """The table's newest version; an empty one of the schema `like` if it has none."""
        versions = self.versions(name)
        if not versions:
            if like is None:
                raise FileNotFoundError(f"no table {name} in {self.root}")
            return self.spark.createDataFrame([], like)
        return self.spark.read.parquet(f"{self.root}/{name}/{versions[-1]}")

    def save(self, name: str, df: DataFrame) -> DataFrame:
        versions = self.versions(name)
        version = versions[-1] + 1 if versions else 0
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/{version}")
        for old in versions[: max(0, len(versions) + 1 - KEEP)]:
            self._fs().delete(self._path(f"{self.root}/{name}/{old}"), True)
        return self.table(name)
