"""Incremental forms (Z01-Z08, J17, F12, A28): Structured Streaming over files, and merges by key in foreachBatch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import RECORD
from ..scratch import listed
from . import awaiting


def records(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """New JSON-lines files as they come."""
    return spark.readStream.schema(RECORD).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{json,jsonl}").option("maxFilesPerTrigger", files_per_trigger).json(path)


def merge_new(stream: DataFrame, table: str, keys: list[str], checkpoint: str, partition_by: list[str] | None = None, known: DataFrame | None = None) -> StreamingQuery:
    """Rows whose key the table lacks are appended, batch by batch. The stream's state is the memory of the table's keys
    (RocksDB, in the checkpoint), so no batch reads the table; the sink's log makes a repeated batch append nothing. A key that comes several times in a batch is stored
    once. `known` holds keys that count as stored when the checkpoint is new: those of a table that was filled otherwise. A table that
    has rows without this checkpoint is refused: it would get them twice.
    """
    spark = stream.sparkSession
    if not listed(spark, f"{checkpoint}/offsets"):
        if listed(spark, table):
            raise ValueError(f"{table} was filled with another checkpoint; give its keys as `known` and write beside it")
    else:
        known = None if known is None else known.limit(0)  # the state has them
    return awaiting.start(awaiting.first_seen(stream, keys, known), table, checkpoint, partition_by)


def day_counts(stream: DataFrame, ts: str = "ts", key: str = "event_type", horizon: str = "3 days") -> DataFrame:
    """Counts by UTC day, released once the stream has passed the day's end by the horizon; later rows are dropped."""
    return stream.withWatermark(ts, horizon).groupBy(F.window(ts, "1 day").alias("w"), key).agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("day"), key, "n")


def once(stream: DataFrame, keys: list[str], ts: str = "ts", horizon: str = "3 days") -> DataFrame:
    """One row a key; state is kept no longer than the horizon."""
    return stream.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(keys)


def comments_of_posts(posts: DataFrame, comments: DataFrame, horizon: str = "3 days") -> DataFrame:
    """Comments joined to their post while it waits: not before it, not later than the horizon after it. Watermarks evict state on both sides."""
    p = posts.select(F.col("item_id").alias("post_id"), F.col("ts").alias("post_ts")).withWatermark("post_ts", horizon)
    c = comments.withWatermark("ts", horizon)
    return c.join(p, F.expr(f"submission_item = post_id AND ts >= post_ts AND ts <= post_ts + interval {horizon}"))


def not_future(stream: DataFrame, ts: str = "ts") -> DataFrame:
    """Z05."""
    return stream.filter(F.col(ts) < F.current_timestamp())


def run_for(query: StreamingQuery, seconds: float) -> bool:
    """Wait so long, then stop; whether it had ended by itself."""
    ended = query.awaitTermination(seconds)
    if not ended:
        query.stop()
    return bool(ended)
