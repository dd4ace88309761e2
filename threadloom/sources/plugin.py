"""The source plug-in surface as a Python data source. A feed is any object that names its days and yields raw rows of one day;
each day is a partition, so days are read side by side and a lost task rereads one day.

    spark.dataSource.register(source_of("forum", feed))
    spark.read.format("forum").option("start", "2026-06-01").option("end", "2026-06-30").load()
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta
from typing import Protocol

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


class Feed(Protocol):
    """Has to be picklable; opens its connection when a day is read."""

    schema: str

    def rows(self, day: date, options: dict[str, str]) -> Iterator[tuple]: ...


class Day(InputPartition):
    def __init__(self, value: date):
        super().__init__(value.toordinal())


def days(start: str, end: str) -> list[date]:
    """Inclusive UTC days, whichever of the two comes first."""
    a, b = sorted((date.fromisoformat(start), date.fromisoformat(end)))
    return [a + timedelta(n) for n in range((b - a).days + 1)]


class FeedReader(DataSourceReader):
    def __init__(self, feed: Feed, options: dict[str, str]):
        self.feed, self.options = feed, options

    def partitions(self) -> list[Day]:
        return [Day(d) for d in days(self.options["start"], self.options["end"])]

    def read(self, partition: Day) -> Iterator[tuple]:
        yield from self.feed.rows(date.fromordinal(partition.value), self.options)


def source_of(label: str, feed: Feed) -> type[DataSource]:
    class FeedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return label

        def schema(self) -> str:
            return feed.schema

        def reader(self, schema: StructType) -> DataSourceReader:
            return FeedReader(feed, dict(self.options))

    return FeedSource
