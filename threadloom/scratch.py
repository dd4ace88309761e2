"""A folder for tables on their way: shared by the driver and all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def base(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local folder only where that is unset and the master is local, as in tests."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.gettempdir() + "/threadloom"
    return top.rstrip("/")


def folder(spark: SparkSession) -> str:
    """A new one of one's own; whoever owns the run deletes it afterwards."""
    return f"{base(spark)}/{uuid.uuid4().hex}"


def held(df: DataFrame) -> DataFrame:
    """The rows as a table there: computed once, however often they are read."""
    at = folder(df.sparkSession)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def filesystem(uri: str):
    """In a Python task: Arrow's file system for one of Hadoop's addresses, and the path in it. `s3a` is Hadoop's name for what Arrow calls `s3`."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if scheme == "file" or not rest:
        return fs.LocalFileSystem(), "/" + (rest or uri).lstrip("/")
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}")


def hadoop(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path as its object."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def listed(spark: SparkSession, folder_: str) -> list[tuple[str, int, int]]:
    """All files below a folder: address, length, time of the last change. Names and sizes only."""
    fs, top = hadoop(spark, folder_)
    if not fs.exists(top):
        return []
    found, it = [], fs.listFiles(top, True)
    while it.hasNext():
        s = it.next()
        if not any(part[0] in "._" for part in s.getPath().toString().removeprefix(fs.makeQualified(top).toString()).split("/") if part):
            found.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(found)
