"""An archive that answers in pages, as a Python data source for batches and streams.

An archive gives rows in time order, a page at a time, from a second on. The pager asks again from one second before a page's last
row, so rows of one second that a page's end parts are not missed, and drops ids it has had; a page without anything new moves on. Days are
partitions, so days are paged side by side and a lost task pages one day again. With `prune`, a filter on the day or the time leaves out days.

    spark.dataSource.register(paged_source("archive", TableArchive("/folder")))
    spark.readStream.format("archive").option("start", "2026-06-01").load()
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import UTC, date, datetime
from typing import Any, Protocol

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

DAY = 86_400
PAGE = 100
#: Pages grow up to this where more rows share a second than a page holds; an archive's own `largest` comes before it.
LARGEST_PAGE = 100_000

# the source travels with its code: the process that plans a read knows no shipped packages
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Archive(Protocol):
    """Has to be picklable; opens its connection when it is asked. Rows are dicts with `id` and `created_utc` (seconds) at least."""

    schema: str

    def page(self, after: int, before: int, limit: int) -> list[dict[str, Any]]:
        """At most `limit` rows from second `after` on (itself included or not) and before `before`, by time."""

    def newest(self) -> int | None:
        """The last second that has rows."""


def pages(archive: Archive, after: int, before: int, limit: int = PAGE, largest: int = LARGEST_PAGE) -> Iterator[dict[str, Any]]:
    """Each row of [after, before) once, in order. The ids kept are those of the second that is asked for again, not of the whole walk."""
    cursor, seen, size = after - 1, {}, limit
    while cursor < before:
        page = archive.page(cursor, before, size)
        fresh = [r for r in page if str(r["id"]) not in seen]
        for r in fresh:
            seen[str(r["id"])] = int(r["created_utc"])
            if after <= int(r["created_utc"]) < before:
                yield r
        if len(page) < size:
            return
        last = int(page[-1]["created_utc"])
        if fresh and last - 1 > cursor:
            cursor, size = last - 1, limit
        elif size * 2 <= largest:
            size *= 2  # the same page would come back: what is behind it can only be reached by a larger one
        else:  # on, first to the page's last second, which a server may leave out or not, then past it
            cursor, size = max(last, cursor + 1), limit
        seen = {i: t for i, t in seen.items() if t >= cursor}


class TableArchive:
    """Pages out of Parquet files in folders `day=YYYY-MM-DD`, on any file system that Arrow reads: what a stored archive looks like, and
    the stand-in for one behind a network."""

    largest = sys.maxsize  # no server limits its pages: a second's rows are all reached, however many they are

    def __init__(self, folder: str, schema: str):
        self.folder, self.schema = folder.rstrip("/"), schema
        self.columns = [part.split()[0] for part in schema.split(",") if part.split()[0] != "day"]
        self._day: tuple[str, Any, Any] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_day": None}

    def _at(self):
        from pyarrow import fs

        if "://" in self.folder or self.folder.startswith("file:"):
            uri = self.folder if "://" in self.folder else "file://" + self.folder.removeprefix("file:")
            return fs.FileSystem.from_uri(uri)
        return fs.LocalFileSystem(), self.folder

    def _days(self) -> list[str]:
        from pyarrow import fs

        system, top = self._at()
        found = system.get_file_info(fs.FileSelector(top, allow_not_found=True))
        return sorted(f.base_name.removeprefix("day=") for f in found if f.base_name.startswith("day="))

    def _rows(self, day: str) -> tuple[list[int], Any]:
        """A day's rows by time, and their seconds, as columns: held until another day is asked for."""
        import pyarrow as pa
        from pyarrow import compute as pc
        from pyarrow import fs
        from pyarrow import parquet as pq

        if self._day is None or self._day[0] != day:
            self._day = None
            system, top = self._at()
            files = [f.path for f in system.get_file_info(fs.FileSelector(f"{top}/day={day}", allow_not_found=True)) if f.path.endswith(".parquet")]
            read = [pq.read_table(f, filesystem=system, columns=self.columns, partitioning=None) for f in sorted(files)]
            if read:
                rows = pa.concat_tables(read)
                by_time = pa.table({"t": rows["created_utc"], "id": pc.cast(rows["id"], pa.string())})
                rows = rows.take(pc.sort_indices(by_time, sort_keys=[("t", "ascending"), ("id", "ascending")])).combine_chunks()
                self._day = (day, rows["created_utc"].to_numpy(), rows)
            else:
                self._day = (day, [], None)
        return self._day[1:]

    def page(self, after: int, before: int, limit: int) -> list[dict[str, Any]]:
        out: list[dict[str, Any]] = []
        for day in range(after // DAY, (before - 1) // DAY + 1):
            seconds, rows = self._rows(str(datetime.fromtimestamp(day * DAY, UTC).date()))
            first = bisect_left(seconds, after)  # a page costs its own rows, however many its day has
            n = min(limit - len(out), bisect_left(seconds, before) - first)
            if n > 0:
                out += rows.slice(first, n).to_pylist()
            if len(out) == limit:
                break
        return out

    def newest(self) -> int | None:
        days = self._days()
        seconds = self._rows(days[-1])[0] if days else ()
        return int(seconds[-1]) if len(seconds) else None


class Stretch(InputPartition):
    """Seconds of one UTC day."""

    def __init__(self, start: int, end: int):
        super().__init__((start, end))


def stretches(start: int, end: int) -> list[Stretch]:
    """[start, end) cut at midnights."""
    cuts = [start, *range((start // DAY + 1) * DAY, end, DAY), end]
    return [Stretch(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]


def second_of(day: str) -> int:
    return int(datetime.fromisoformat(day).replace(tzinfo=UTC).timestamp())


def _tuples(archive: Archive, names: list[str], start: int, end: int, limit: int) -> Iterator[tuple]:
    for r in pages(archive, start, end, limit, getattr(archive, "largest", LARGEST_PAGE)):
        yield tuple(date.fromordinal(719_163 + int(r["created_utc"]) // DAY) if n == "day" else r.get(n) for n in names)


class PagedReader(DataSourceReader):
    """All of the days from `start` to `end`, less what filters leave out."""

    def __init__(self, archive: Archive, names: list[str], options: dict[str, str]):
        self.archive, self.names, self.limit = archive, names, int(options.get("page", PAGE))
        self.start = second_of(options["start"])
        self.end = second_of(options["end"]) + DAY if "end" in options else None
        self.only: set[date] | None = None

    def partitions(self) -> list[Stretch]:
        end = self.end
        if end is None:
            newest = self.archive.newest()
            end = self.start if newest is None else newest + 1
        found = stretches(self.start, end)
        if self.only is not None:
            found = [p for p in found if datetime.fromtimestamp(p.value[0], UTC).date() in self.only]
        return found or [Stretch(0, 0)]  # Spark wants one

    def read(self, partition: Stretch) -> Iterator[tuple]:
        yield from _tuples(self.archive, self.names, *partition.value, self.limit)


class PrunedReader(PagedReader):
    """As PagedReader, with filters that choose partitions (option `prune`). Spark has to have its pushdown to Python sources on: within filters_pushed()."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Filters on `day` and `created_utc` choose partitions. Spark applies those that don't hold by that alone."""
        for f in filters:
            column = getattr(f, "attribute", ())
            if column == ("day",):
                known = self._take_day(f)
            elif column == ("created_utc",):
                known = self._take_second(f)
            else:
                known = False
            if not known:
                yield f

    def _take_day(self, f: Filter) -> bool:
        at = lambda d: second_of(str(d))
        if isinstance(f, EqualTo):
            self._cut(at(f.value), at(f.value) + DAY)
        elif isinstance(f, In):
            chosen = set(f.value)
            self.only = chosen if self.only is None else self.only & chosen
        elif isinstance(f, GreaterThanOrEqual):
            self._cut(at(f.value), None)
        elif isinstance(f, GreaterThan):
            self._cut(at(f.value) + DAY, None)
        elif isinstance(f, LessThanOrEqual):
            self._cut(None, at(f.value) + DAY)
        elif isinstance(f, LessThan):
            self._cut(None, at(f.value))
        else:
            return False
        return True

    def _take_second(self, f: Filter) -> bool:
        if isinstance(f, EqualTo):
            self._cut(f.value, f.value + 1)
        elif isinstance(f, GreaterThanOrEqual):
            self._cut(f.value, None)
        elif isinstance(f, GreaterThan):
            self._cut(f.value + 1, None)
        elif isinstance(f, LessThanOrEqual):
            self._cut(None, f.value + 1)
        elif isinstance(f, LessThan):
            self._cut(None, f.value)
        else:
            return False
        return True

    def _cut(self, start: int | None, end: int | None) -> None:
        if start is not None:
            self.start = max(self.start, start)
        if end is not None:
            self.end = end if self.end is None else min(self.end, end)


class PagedStream(DataSourceStreamReader):
    """A stream whose offset is a second: a batch covers [start, end) whole, so a restart repeats nothing. `lag` seconds before the
    newest row are left for later, where rows may still come."""

    def __init__(self, archive: Archive, names: list[str], options: dict[str, str]):
        self.archive, self.names, self.limit = archive, names, int(options.get("page", PAGE))
        self.start, self.lag = second_of(options["start"]), int(options.get("lag", 0))

    def initialOffset(self) -> dict:
        return {"at": self.start}

    def latestOffset(self) -> dict:
        newest = self.archive.newest()
        return {"at": max(self.start, newest + 1 - self.lag) if newest is not None else self.start}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        return stretches(start["at"], end["at"])

    def read(self, partition: Stretch) -> Iterator[tuple]:
        yield from _tuples(self.archive, self.names, *partition.value, self.limit)

    def commit(self, end: dict) -> None:
        pass


def paged_source(label: str, archive: Archive) -> type[DataSource]:
    class PagedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return label

        def schema(self) -> str:
            return archive.schema

        def reader(self, schema: StructType) -> DataSourceReader:
            kind = PrunedReader if str(self.options.get("prune", "")).lower() == "true" else PagedReader
            return kind(archive, schema.fieldNames(), dict(self.options))

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return PagedStream(archive, schema.fieldNames(), dict(self.options))

    return PagedSource




PUSHED = "spark.sql.python.filterPushdown.enabled"


@contextmanager
def filters_pushed(spark: SparkSession) -> Iterator[None]:
    """Frames that are planned within hand their filters to the source; the caller's setting comes back afterwards."""
    before = spark.conf.get(PUSHED, None)
    spark.conf.set(PUSHED, "true")
    try:
        yield
    finally:
        spark.conf.unset(PUSHED) if before is None else spark.conf.set(PUSHED, before)
