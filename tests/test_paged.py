"""The paged archive: overlap, stale pages, restarts, day filters."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from threadloom.plans import catalog, catalog_io
from threadloom.sources import paged

DAY = paged.DAY


class Listed:
    """Pages out of a list; `after` may or may not include its second."""

    schema = "id long, created_utc long"

    def __init__(self, rows, inclusive=True, most=10**9):
        self.rows, self.inclusive, self.most, self.asked = sorted(rows, key=lambda r: r["created_utc"]), inclusive, most, []

    def page(self, after, before, limit):
        self.asked.append((after, limit))
        low = after if self.inclusive else after + 1
        return [r for r in self.rows if low <= r["created_utc"] < before][: min(limit, self.most)]

    def newest(self):
        return self.rows[-1]["created_utc"] if self.rows else None


def rows_at(*seconds):
    return [{"id": i, "created_utc": s} for i, s in enumerate(seconds)]


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("limit", [2, 3, 7, 50])
def test_each_row_once_in_order(inclusive, limit):
    r = random.Random(limit)
    for _ in range(40):
        archive = Listed(rows_at(*(r.choice([r.randrange(60), 30]) for _ in range(r.randint(0, 60)))), inclusive)
        got = list(paged.pages(archive, 5, 55, limit))
        assert sorted(x["id"] for x in got) == sorted(x["id"] for x in archive.rows if 5 <= x["created_utc"] < 55)
        assert [x["created_utc"] for x in got] == sorted(x["created_utc"] for x in got)


def test_the_cursor_goes_back_a_second_and_stale_pages_advance():
    archive = Listed(rows_at(10, 10, 11, 11, 12, 40))
    assert [x["created_utc"] for x in paged.pages(archive, 10, 100, 3)] == [10, 10, 11, 11, 12, 40]
    assert archive.asked[:2] == [(9, 3), (10, 3)]  # the page ended in second 11
    assert any(limit == 6 for _, limit in archive.asked)  # 10, 10, 11 again: stale, so a larger page
    # a server that never gives more than two rows a page: a second with more of them is left behind, not asked for for ever
    small = Listed(rows_at(1, 1, 1, 1, 9), most=2)
    got = [x["created_utc"] for x in paged.pages(small, 0, 100, 2, largest=2)]
    assert got == [1, 1, 9]


def test_memory_is_the_last_seconds():
    archive = Listed(rows_at(*range(5000)))
    seen = []
    page = archive.page
    archive.page = lambda *a: seen.append(a) or page(*a)
    assert sum(1 for _ in paged.pages(archive, 0, 10_000, 50)) == 5000 and len(seen) < 120


def stored(spark, at, rows, mode="append"):
    df = spark.createDataFrame([(x["id"], x["created_utc"]) for x in rows], "id long, created_utc long")
    df.withColumn("day", F.date_from_unix_date((F.col("created_utc") / DAY).cast("int")).cast("string")).coalesce(1).write.mode(mode).partitionBy("day").parquet(at)
    return paged.TableArchive(at, "id long, created_utc long, day date")


def test_day_filters_choose_partitions(spark, tmp_path):
    rows = rows_at(*(d * DAY + s for d in range(20_000, 20_010) for s in (0, 5, 5, DAY - 1)))
    archive = stored(spark, str(tmp_path / "a"), rows)
    spark.dataSource.register(paged.paged_source("days", archive))
    day = lambda n: date.fromordinal(719_163 + 20_000 + n)
    cases = [
        (F.col("day") == F.lit(day(3)), {3}), (F.col("day").isin(day(1), day(8), day(77)), {1, 8}), (F.col("day") >= F.lit(day(8)), {8, 9}), ((F.col("day") > F.lit(day(1))) & (F.col("day") < F.lit(day(4))), {2, 3}),
        (F.col("created_utc") >= 20_009 * DAY + 5, {9}), ((F.col("day") <= F.lit(day(1))) & (F.col("id") % 2 == 0), {0, 1}), (F.col("created_utc") == 20_004 * DAY + 5, {4}), (F.col("created_utc") < 20_000 * DAY, set()),
    ]
    for condition, days in cases:
        with paged.filters_pushed(spark):
            df = spark.read.format("days").option("start", "2024-10-04").option("page", "3").option("prune", "true").load().filter(condition)
            got = df.collect()
            assert df.rdd.getNumPartitions() == max(1, len(days)), condition
        plain = spark.createDataFrame([(x["id"], x["created_utc"], day(x["created_utc"] // DAY - 20_000)) for x in rows], "id long, created_utc long, day date").filter(condition).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, plain))
    assert spark.read.format("days").option("start", "2024-10-01").option("end", "2024-10-06").load().count() == 4 * len(set(range(20_000, 20_010)) & set(range(19_997, 20_003)))


def test_a_restart_repeats_nothing(spark, tmp_path):
    at, out, ckpt = str(tmp_path / "a"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    rows = rows_at(*(d * DAY + s for d in range(20_000, 20_006) for s in (0, 7, 7, 7, DAY - 1)))

    def run(part):
        archive = stored(spark, at, part)
        spark.dataSource.register(paged.paged_source("growing", archive))
        stream = spark.readStream.format("growing").option("start", "2024-10-04").option("page", "2").load()
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        assert q.awaitTermination(200) and not q.exception()
        return q

    run(rows[:11])  # ends within a day
    run(rows[11:21])
    run(rows[21:])
    got = [r["id"] for r in spark.read.parquet(out).collect()]
    assert sorted(got) == [x["id"] for x in rows]
    assert paged.PagedStream(stored(spark, at, [], "append"), ["id"], {"start": "2024-10-04", "lag": "100"}).latestOffset() == {"at": rows[-1]["created_utc"] + 1 - 100}
    assert paged.PagedStream(paged.TableArchive(str(tmp_path / "none"), "id long"), ["id"], {"start": "2024-10-04"}).latestOffset() == {"at": 20_000 * DAY}


def test_a_page_costs_its_own_rows(spark, tmp_path):
    """A page of a long day is a slice of it, not a walk over the day."""
    archive = stored(spark, str(tmp_path / "long"), rows_at(*(20_000 * DAY + s // 3 for s in range(30_000))))
    assert archive.page(20_000 * DAY + 9_000, 20_001 * DAY, 4) == [{"id": i, "created_utc": 20_000 * DAY + i // 3} for i in (27_000, 27_001, 27_002, 27_003)]
    touched, slices = [0], []
    seconds, rows = archive._rows("2024-10-04")

    class Counted:
        def __len__(self):
            return len(seconds)

        def __getitem__(self, i):
            touched[0] += 1
            return seconds[i]

    class Sliced:
        def slice(self, first, n):
            slices.append(n)
            return rows.slice(first, n)

    archive._day = ("2024-10-04", Counted(), Sliced())
    assert len(archive.page(20_000 * DAY + 5_000, 20_001 * DAY, 40)) == 40 and slices == [40] and touched[0] < 50


def test_a_crowded_second_is_paged_once_it_has_outgrown_a_page():
    archive = Listed(rows_at(*[10] * 2000, *[20] * 2000))
    asked, page = [], archive.page
    archive.page = lambda *a: asked.append(len(page(*a))) or page(*a)
    assert sum(1 for _ in paged.pages(archive, 0, 100, 40)) == 4000 and sum(asked) < 3 * 4000 and len(asked) < 20


def test_a_stream_is_waited_for_to_its_end(spark, tmp_path, monkeypatch):
    """A wait that ends first must not stop the stream and leave a part of its rows as the result."""
    wait = catalog_io.ingest.run_for
    monkeypatch.setattr(catalog_io.ingest, "run_for", lambda q, _: wait(q, 0.01))
    seconds = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 5000)
    spark.range(500).select(F.col("id").alias("event_id"), seconds.alias("ts"), F.lit("view").alias("event_type")).write.parquet(str(tmp_path / "events.parquet"))
    got = [r["id"] for r in catalog.QUERIES["s06_paged_stream"](spark, str(tmp_path)).select("id").collect()]
    assert sorted(got) == list(range(500))


def test_a_failed_stream_has_no_result(spark, tmp_path):
    stream = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", "5").load().select(F.raise_error(F.lit("broken page")).alias("x"))
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="broken page"):
        catalog_io._run(q)


def test_a_second_larger_than_any_page_comes_whole(spark, tmp_path):
    archive = stored(spark, str(tmp_path / "crowd"), rows_at(*[20_000 * DAY + 7] * 70_000, 20_000 * DAY + 9))
    got = [i for (i,) in paged._tuples(archive, ["id"], 20_000 * DAY, 20_001 * DAY, 60)]
    assert sorted(got) == list(range(70_001))
