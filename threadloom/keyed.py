"""Tables that are changed by key and merged when they are read.

A table is a log of manifests over immutable Parquet files. The base lies in buckets of the keys' hash; a change writes a delta of its
own rows and a manifest that names it, so it costs what it changes, not what is there. A reader takes one manifest, hence one state: base
rows whose key no delta has, and each key's row of its newest delta. `compact` folds deltas into the buckets that they touch and
leaves all others alone.

A commit is the rename of a manifest to the next number, which fails if another writer was there first. Whoever fails takes the new state
and tries again: an upsert is laid on top of it, an insert looks for its keys anew, a compaction keeps the deltas that came meanwhile and
gives up if somebody else has folded. So no writer's rows get lost, and a job that dies leaves files that no manifest names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 16
#: Deltas are broadcast against the base up to so many rows, counted when they are written.
BROADCAST_ROWS = 200_000
GONE, SEQ, BUCKET = "_gone", "_seq", "_bucket"


class Conflict(RuntimeError):
    """Another writer has changed what this one was built on."""


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path, self._jvm = jvm.org.apache.hadoop.fs.Path, jvm
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # --- log ---

    @classmethod
    def create(cls, rows: DataFrame, root: str, keys: list[str], buckets: int = BUCKETS) -> KeyedTable:
        table = cls(rows.sparkSession, root)
        if table.version() is not None:
            raise FileExistsError(f"{root} is a table")
        at = table._write_base(rows.select(*rows.columns), keys, buckets)
        first = {"keys": keys, "buckets": buckets, "schema": rows.schema.json(), "base": at, "deltas": [], "seq": 0}
        if not table._put(0, first):
            raise Conflict(f"{root} was created by somebody else")
        return table

    def _log(self, n: int) -> str:
        return f"{self.root}/_log/{n:010}.json"

    def version(self) -> int | None:
        at = self._path(f"{self.root}/_log")
        names = [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "."), default=None)

    def manifest(self, n: int | None = None) -> dict:
        n = self.version() if n is None else n
        if n is None:
            raise FileNotFoundError(f"no table in {self.root}")
        stream = self._fs.open(self._path(self._log(n)))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")) | {"version": n}
        finally:
            stream.close()

    def _put(self, n: int, manifest: dict) -> bool:
        """Make it manifest n; false if there is one already."""
        staged = self._path(f"{self.root}/_log/.{uuid.uuid4().hex}")
        out = self._fs.create(staged, True)
        try:
            out.write(bytearray(json.dumps({k: v for k, v in manifest.items() if k != "version"}).encode()))
        finally:
            out.close()
        hadoop = self._jvm.org.apache.hadoop.fs
        place = hadoop.FileContext.getFileContext(staged.toUri() if staged.toUri().getScheme() else self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
        try:
            place.rename(self._fs.makeQualified(staged), self._fs.makeQualified(self._path(self._log(n))), none)
        except Exception as e:  # noqa: BLE001
            self._fs.delete(staged, False)
            if self._fs.exists(self._path(self._log(n))):
                return False
            raise e
        return True

    def _commit(self, change: Callable[[dict], dict]) -> int:
        while True:
            now = self.manifest()
            if self._put(now["version"] + 1, change(now)):
                return now["version"] + 1

    # --- data ---

    def _bucket(self, keys: list[str], buckets: int):
        return F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in keys)), F.lit(buckets)).cast("int")

    def _write_base(self, rows: DataFrame, keys: list[str], buckets: int) -> dict[str, str]:
        """Bucket -> folder of its files."""
        at = f"{self.root}/data/{uuid.uuid4().hex}"
        rows.withColumn(BUCKET, self._bucket(keys, buckets)).repartition(F.col(BUCKET)).sortWithinPartitions(BUCKET, *keys).write.partitionBy(BUCKET).parquet(at)
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(at))]
        return {n.removeprefix(f"{BUCKET}="): f"{at}/{n}" for n in names if n.startswith(f"{BUCKET}=")}

    def _write_delta(self, rows: DataFrame, m: dict, gone: bool) -> dict | None:
        """The manifest's entry of a new delta; None for no rows. A key must be given once, without nulls."""
        at = f"{self.root}/data/{uuid.uuid4().hex}"
        schema = StructType.fromJson(json.loads(m["schema"]))
        cols = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        rows.select(*cols, F.lit(gone).alias(GONE)).withColumn(BUCKET, self._bucket(m["keys"], m["buckets"])).write.parquet(at)
        found = self.spark.read.parquet(at)
        null = F.greatest(*(F.col(k).isNull().cast("int") for k in m["keys"]), F.lit(0))
        by_key = found.groupBy(*m["keys"]).agg(F.count("*").alias("_times"), F.max(null).alias("_null"), F.first(BUCKET).alias("_in"))
        n, nulls, most, buckets = by_key.agg(F.sum("_times"), F.max("_null"), F.max("_times"), F.collect_set("_in")).first()
        if nulls or not n or most > 1:
            self._fs.delete(self._path(at), True)
            if n:
                raise ValueError("a key is null" if nulls else "a key is given twice")
            return None
        return {"path": at, "rows": n, "buckets": sorted(buckets)}

    def _base(self, m: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(json.loads(m["schema"]))
        paths = [p for b, p in m["base"].items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _newest(self, m: dict, buckets: list[int] | None = None) -> DataFrame:
        """Each changed key's last row, deletions too."""
        parts = [self.spark.read.parquet(d["path"]).withColumn(SEQ, F.lit(d["seq"])) for d in m["deltas"]]
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        if buckets is not None:
            rows = rows.filter(F.col(BUCKET).isin(buckets))
        last = Window.partitionBy(*m["keys"]).orderBy(F.desc(SEQ))
        return rows.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")

    def _merged(self, m: dict, buckets: list[int] | None = None) -> DataFrame:
        base = self._base(m, buckets)
        if not m["deltas"]:
            return base
        newest = self._newest(m, buckets)
        changed = newest.select(*m["keys"])
        if sum(d["rows"] for d in m["deltas"]) <= BROADCAST_ROWS:
            changed = F.broadcast(changed)
        return base.join(changed, m["keys"], "left_anti").select(*base.columns).unionByName(newest.filter(f"NOT {GONE}").select(*base.columns))

    # --- use ---

    def read(self, version: int | None = None) -> DataFrame:
        return self._merged(self.manifest(version))

    def _add(self, entry: dict) -> int:
        return self._commit(lambda m: m | {"seq": m["seq"] + 1, "deltas": [*m["deltas"], entry | {"seq": m["seq"] + 1}]})

    def upsert(self, rows: DataFrame) -> int:
        """These rows replace those with their keys. The new version's number."""
        entry = self._write_delta(rows, self.manifest(), False)
        return self._add(entry) if entry else self.version()

    def delete(self, keys: DataFrame) -> int:
        entry = self._write_delta(keys, self.manifest(), True)
        return self._add(entry) if entry else self.version()

    def insert_new(self, rows: DataFrame) -> int:
        """Rows whose keys aren't there; of a key given twice the least row."""
        while True:
            m = self.manifest()
            once = Window.partitionBy(*m["keys"]).orderBy(*(F.col(c) for c in rows.columns))
            fresh = rows.join(self._merged(m).select(*m["keys"]), m["keys"], "left_anti").withColumn("_n", F.row_number().over(once)).filter("_n = 1").drop("_n")
            entry = self._write_delta(fresh, m, False)
            if entry is None:
                return m["version"]
            new = m | {"seq": m["seq"] + 1, "deltas": [*m["deltas"], entry | {"seq": m["seq"] + 1}]}
            if self._put(m["version"] + 1, new):
                return m["version"] + 1
            self._fs.delete(self._path(entry["path"]), True)  # somebody else's rows may have these keys

    def compact(self, on: dict | None = None) -> int:
        """Fold the deltas into the buckets that they touch."""
        m = on or self.manifest()
        if not m["deltas"]:
            return m["version"]
        buckets = sorted({b for d in m["deltas"] for b in d["buckets"]})
        fresh = self._write_base(self._merged(m, buckets), m["keys"], m["buckets"])

        def change(now: dict) -> dict:
            n = len(m["deltas"])
            if now["base"] != m["base"] or now["deltas"][:n] != m["deltas"]:
                raise Conflict("somebody else has folded these deltas")
            kept = {b: p for b, p in m["base"].items() if int(b) not in buckets}
            return now | {"base": kept | fresh, "deltas": now["deltas"][n:]}

        return self._commit(change)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the folders that none of the last manifests names, and older manifests. Not while somebody writes."""
        last = self.version()
        held = [self.manifest(n) for n in range(max(0, last - keep + 1), last + 1) if self._fs.exists(self._path(self._log(n)))]
        named = {p.rsplit(f"/{BUCKET}=", 1)[0].rsplit("/", 1)[-1] for m in held for p in [*m["base"].values(), *(d["path"] for d in m["deltas"])]}
        gone = [s.getPath() for s in self._fs.listStatus(self._path(f"{self.root}/data")) if s.getPath().getName() not in named]
        for p in gone:
            self._fs.delete(p, True)
        for n in range(max(0, last - keep + 1)):
            self._fs.delete(self._path(self._log(n)), False)
        return [p.getName() for p in gone]
