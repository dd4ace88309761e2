"""Counts over a folder of record files that follow its changes. What each file holds is kept by file; a refresh reads the files that are
new or differ in size or time, replaces their rows, takes out those of files that are gone, and leaves all others alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..keyed import KeyedTable
from ..scratch import hadoop, listed
from . import files

ROWS = "file string, item_id string, record_type string, subreddit string, created_s long"
SEEN = "file string, changed long, size long"
SUFFIXES = (".json", ".jsonl")
#: Deltas after which both tables are folded.
FOLD = 8


def _opened(spark: SparkSession, root: str, schema: str, keys: list[str]) -> KeyedTable:
    table = KeyedTable(spark, root)
    return table if table.version() is not None else KeyedTable.create(spark.createDataFrame([], schema), root, keys)


class FileIndex:
    """The records of the files below `path`, by file, stored below `root`."""

    def __init__(self, spark: SparkSession, path: str, root: str):
        self.spark, self.path = spark, path
        self.rows = _opened(spark, f"{root.rstrip('/')}/rows", ROWS, ["file", "item_id"])
        self.seen = _opened(spark, f"{root.rstrip('/')}/files", SEEN, ["file"])

    def _name(self, file: str) -> str:
        """The file's name as Spark gives it with the rows."""
        return hadoop(self.spark, file)[1].toUri().toString().replace("file:///", "file:/")

    def refresh(self) -> dict[str, list[str]]:
        """Bring the index up to the files; which were read, and which are gone. Rows are replaced before the files count as seen, so a
        refresh that dies is done again, to the same result."""
        now = {f: (at, size) for f, size, at in listed(self.spark, self.path) if f.endswith(SUFFIXES)}
        before = {r["file"]: (r["changed"], r["size"]) for r in self.seen.read().collect()}  # names and sizes of files
        read, gone = sorted(f for f in now if now[f] != before.get(f)), sorted(f for f in before if f not in now)
        if not read and not gone:
            return {"read": [], "gone": []}
        old = self.rows.read().filter(F.col("file").isin([self._name(f) for f in read + gone])).select("file", "item_id")
        fresh = self._records(read)
        self.rows.delete(old.join(fresh.select("file", "item_id"), ["file", "item_id"], "left_anti"))
        self.rows.upsert(fresh)
        if gone:
            self.seen.delete(self.spark.createDataFrame([(f,) for f in gone], "file string"))
        if read:
            self.seen.upsert(self.spark.createDataFrame([(f, *now[f]) for f in read], SEEN))
        for table in (self.rows, self.seen):
            if len(table.manifest()["deltas"]) >= FOLD:
                table.compact()
        return {"read": read, "gone": gone}

    def _records(self, paths: list[str]) -> DataFrame:
        """The good records of some files, each identity once a file."""
        if not paths:
            return self.spark.createDataFrame([], ROWS)
        got = files.jsonl(self.spark, paths, unique=False).filter("NOT bad")
        made = F.unix_seconds(F.col("created_utc").try_cast("timestamp"))
        rows = got.select(F.replace("_file", F.lit("file:///"), F.lit("file:/")).alias("file"), "item_id", "record_type", "subreddit", made.alias("created_s"))
        return rows.groupBy("file", "item_id").agg(F.min(F.struct("record_type", "subreddit", "created_s")).alias("r")).select("file", "item_id", "r.*")

    def items(self) -> DataFrame:
        """Each identity once, as the first file by name has it."""
        first = self.rows.read().groupBy("item_id").agg(F.min_by(F.struct("record_type", "subreddit", "created_s"), F.col("file")).alias("r"))
        return first.select("item_id", "r.*")
