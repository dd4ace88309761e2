"""Streams with keyed state (Z02-Z04, Z06): posts that wait for their comments, and caps by day.

Both keep what is open under a key, set a timer on the event time at which it closes, and forget it when the timer fires. State is
in RocksDB, so it may outgrow memory; what is kept is bounded by the open days, not by the stream's history.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

DAY_MS = 86_400_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# processors travel with their code: the process that asks for their state's shape knows no shipped packages
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _day_end(ms: int) -> int:
    return (ms // DAY_MS + 1) * DAY_MS


def _clear_timers(handle: StatefulProcessorHandle) -> None:
    for at in list(handle.listTimers()):
        handle.deleteTimer(at)


class Awaiting(StatefulProcessor):
    """A post and its comments, under the post's id. The post waits until the watermark has passed its UTC day's end (the watermark
    itself lags by the horizon); comments that came for it by then go out with it.

    A comment whose post isn't there waits until the end of its own day: the post may come behind it. If none has come, it is late (or
    its post was never collected) and goes out as a row of its own, so nothing is lost silently. What a post gets doesn't depend on how
    the stream is cut into batches: comments from the closing time on are late even if they came before the timer fired.
    """

    def __init__(self, horizon_ms: int):
        self.horizon_ms = horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.post = handle.getValueState("post", "ms long")
        self.comments = handle.getListState("comments", "id string, ms long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        posts, comments = [], []
        for frame in rows:
            is_post = frame["record_type"] == "submission"
            posts += frame.loc[is_post, "ms"].tolist()
            comments += frame.loc[~is_post, ["item_id", "ms"]].itertuples(index=False, name=None)
        if posts and not self.post.exists():  # a page that is read again repeats its posts
            self.post.update((min(posts),))
            _clear_timers(self.handle)
            self.handle.registerTimer(_day_end(min(posts)))
        if comments:
            self.comments.appendList([(i, int(ms)) for i, ms in comments])
            if not self.post.exists():
                for end in {_day_end(int(ms)) for _, ms in comments}:
                    self.handle.registerTimer(end)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        held: dict[str, int] = {}
        for i, ms in self.comments.get() if self.comments.exists() else ():
            held[i] = min(ms, held.get(i, ms))  # of repeats the first
        out = []
        if self.post.exists():
            post = self.post.get()[0]
            closing = _day_end(post) + self.horizon_ms
            mine = sorted((ms, i) for i, ms in held.items() if ms < closing)
            held = {i: ms for i, ms in held.items() if ms >= closing}
            self.post.clear()
            out.append((key[0], "released", post, len(mine), [i for _, i in mine]))
        out += [(key[0], "late", ms, 1, [i]) for i, ms in sorted(held.items()) if _day_end(ms) <= passed]
        held = {i: ms for i, ms in held.items() if _day_end(ms) > passed}
        self.comments.clear()
        if held:
            self.comments.put(list(held.items()))
            for end in {_day_end(ms) for ms in held.values()}:
                self.handle.registerTimer(end)
        if out:
            yield pd.DataFrame(out, columns=["post", "kind", "ms", "n", "items"])

    def close(self) -> None:
        pass


RELEASED = "post string, kind string, ms long, n long, items array<string>"


def released_posts(records: DataFrame, horizon: str = "3 days", ts: str = "ts") -> DataFrame:
    """records(item_id, record_type, submission_item, ts) -> post, kind, ms, n, items. `released` rows are posts, each once,
    with the ids of their comments by time; each `late` row is a comment that came when its post was gone, or whose post never came."""
    clocked = records.withWatermark(ts, horizon)
    key = F.when(F.col("record_type") == "submission", F.col("item_id")).otherwise(F.col("submission_item"))
    rows = clocked.select(key.alias("post"), "item_id", "record_type", F.unix_millis(ts).alias("ms"), F.col(ts)).filter("post IS NOT NULL AND ms IS NOT NULL")
    return rows.groupBy("post").transformWithStateInPandas(statefulProcessor=Awaiting(int(seconds(horizon) * 1000)), outputStructType=RELEASED, outputMode="Append", timeMode="EventTime")


class DayCaps(StatefulProcessor):
    """The newest `n` rows of a key's day: no more are held, and the day is forgotten when the watermark has passed its end."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", "us long, id long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = [tuple(x) for x in self.best.get()] if self.best.exists() else []
        if not held:
            self.handle.registerTimer((int(key[-1]) + 1) * DAY_MS)
        for frame in rows:
            top = frame.drop_duplicates(["us", "id"]).sort_values(["us", "id"], ascending=[False, True]).head(self.n)
            held += top[["us", "id"]].itertuples(index=False, name=None)
        once = sorted({(int(us), int(i)) for us, i in held}, key=lambda x: (-x[0], x[1]))[: self.n]
        self.best.put(once)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        held = [tuple(x) for x in self.best.get()]
        self.best.clear()
        yield pd.DataFrame({"key": [key[0]] * len(held), "day": [int(key[-1])] * len(held), "id": [i for _, i in held], "us": [us for us, _ in held]})

    def close(self) -> None:
        pass


def day_caps(rows: DataFrame, key: str, n: int, lag: str = "0 seconds", ts: str = "ts", item: str = "event_id") -> DataFrame:
    """Of each key and UTC day the newest `n` rows, given out when the stream has passed the day's end by the lag: key, day (a
    number of days), id, us. A row that comes twice counts once; equal times are ordered by id."""
    clocked = rows.withWatermark(ts, lag)
    typed = clocked.select(F.col(key).cast("string").alias("key"), F.unix_date(F.to_date(ts)).alias("day"), F.col(item).cast("long").alias("id"), F.unix_micros(ts).alias("us"), F.col(ts))
    out = "key string, day int, id long, us long"
    return typed.groupBy("key", "day").transformWithStateInPandas(statefulProcessor=DayCaps(n), outputStructType=out, outputMode="Append", timeMode="EventTime")


class FirstSeen(StatefulProcessor):
    """A key's first row, once: all that is kept of a key is that it was seen."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "x int")

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        self.seen.update((1,))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            for _ in rows:
                pass
            return
        self.seen.update((1,))
        yield pd.DataFrame({"packed": [min(frame["packed"].min() for frame in rows)]})

    def close(self) -> None:
        pass


def first_seen(stream: DataFrame, keys: list[str], known: DataFrame | None = None) -> DataFrame:
    """Rows whose key neither the stream had before nor `known` holds; of a key's rows in a batch the least as JSON. Keys are
    looked up one by one in RocksDB, so a batch reads what its own keys need, however long the history is."""
    times = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    row = F.to_json(F.struct(*stream.columns), {"ignoreNullFields": "false"} | times)
    packed = stream.select(*keys, row.alias("packed")).dropna(subset=keys).groupBy(*keys)
    begin = None if known is None else known.select(*keys).dropna().distinct().groupBy(*keys)
    out = packed.transformWithStateInPandas(statefulProcessor=FirstSeen(), outputStructType="packed string", outputMode="Append", timeMode="None", initialState=begin)
    return out.select(F.from_json("packed", stream.schema, times).alias("r")).select("r.*")


def seconds(interval: str) -> float:
    """Seconds of `3 days`, `90 minutes` and the like."""
    number, unit = interval.split()
    return float(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


@contextmanager
def rocks(spark: SparkSession) -> Iterator[None]:
    """Queries that are started within keep their state in RocksDB; the caller's setting comes back afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def start(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> StreamingQuery:
    """Run a stream with keyed state over all that is there now, into Parquet files."""
    with rocks(stream.sparkSession):
        return stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).partitionBy(*(partition_by or [])).trigger(availableNow=True).start()
