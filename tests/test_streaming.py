import json
import random
import time

import pytest
from pyspark.sql import functions as F

from threadloom.streaming import awaiting, ingest


def rec(i, ts="2026-08-20T10:00:00Z"):
    return json.dumps({"record_type": "comment", "reddit_fullname": f"t1_{i}", "subreddit": "s", "created_utc": ts})


def drain(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    assert ingest.run_for(q, 120)
    return [tuple(r) for r in df.sparkSession.sql(f"SELECT * FROM {name}").collect()]


def test_merge_new_twice(spark, tmp_path):
    raw, table, ckpt = (str(tmp_path / x) for x in ("raw", "table", "ckpt"))
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.jsonl").write_text(rec("a") + "\n" + rec("b") + "\n" + rec("a") + "\n")
    run = lambda: ingest.merge_new(ingest.records(spark, raw), table, ["reddit_fullname"], ckpt).awaitTermination(120)
    assert run() and spark.read.parquet(table).count() == 2
    (tmp_path / "raw/b.jsonl").write_text(rec("b") + "\n" + rec("c") + "\n")
    assert run() and sorted(r[0] for r in spark.read.parquet(table).select("reddit_fullname").collect()) == ["t1_a", "t1_b", "t1_c"]
    assert run() and spark.read.parquet(table).count() == 3


def test_merge_new_reads_what_the_batch_needs(spark, tmp_path):
    raw, table, ckpt = (str(tmp_path / x) for x in ("raw", "table", "ckpt"))
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.jsonl").write_text("\n".join(rec(i) for i in range(3000)))
    (tmp_path / "raw/b.jsonl").write_text("\n".join(rec(i) for i in range(2990, 3010)))
    known = spark.createDataFrame([("t1_5",), ("t1_3005",), (None,)], "reddit_fullname string")
    go = lambda: ingest.merge_new(ingest.records(spark, raw, 1), table, ["reddit_fullname"], ckpt, known=known)
    q = go()
    assert q.awaitTermination(300) and not q.exception()
    ids = lambda: [r[0] for r in spark.read.parquet(table).select("reddit_fullname").collect()]
    assert sorted(ids()) == sorted(f"t1_{i}" for i in range(3010) if i not in (5, 3005))
    (tmp_path / "raw/c.jsonl").write_text("\n".join(rec(i) for i in (1, 5, 3005, 9000, 9000)))
    q = go()  # from the checkpoint: known keys are in the state
    assert q.awaitTermination(300) and not q.exception()
    assert len(ids()) == 3009 and "t1_9000" in ids()
    last = q.recentProgress[-1]
    metrics = last["stateOperators"][0]["customMetrics"]
    assert last["numInputRows"] == 5 and metrics["rocksdbGetCount"] < 200 and last["stateOperators"][0]["numRowsTotal"] >= 3010
    assert [x["description"].split("[")[0] for x in last["sources"]] == ["FileStreamSource"]
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest.merge_new(ingest.records(spark, raw), table, ["reddit_fullname"], ckpt + "2")


SLOW = "item_id string, record_type string, submission_item string, ts timestamp"


def slow_records(spark):
    """Posts of three days, replies up to two days behind, a stray reply, and a last row that closes all."""
    rows = []
    for p in range(12):
        at = 10 * 86400 + p * 6 * 3600
        rows.append((f"p{p}", "submission", f"p{p}", at))
        rows += [(f"c{p}_{k}", "comment", f"p{p}", at + k * 7 * 3600 + 1) for k in range(8)]
    rows += [("stray", "comment", "nowhere", 280 * 3600), ("p3", "submission", "p3", 258 * 3600), ("end", "submission", "end", 30 * 86400)]
    return sorted(rows, key=lambda x: x[3])


def plain_release(rows, horizon):
    day_end = lambda s: (s // 86400 + 1) * 86400
    passed = max(x[3] for x in rows) - horizon
    posts = {i: s for i, kind, _, s in rows if kind == "submission"}
    out = {("released", i): [] for i, s in posts.items() if day_end(s) <= passed}
    for i, kind, of, s in rows:
        if kind == "comment":
            if of in posts and s < day_end(posts[of]) + horizon:
                if ("released", of) in out:
                    out["released", of].append(i)
            elif day_end(s) <= passed:
                out["late", of + " " + i] = [i]
    return out


@pytest.mark.parametrize("files", [1, 4, 9])
def test_posts_are_released_once_with_their_comments(spark, tmp_path, files):
    rows = slow_records(spark)
    (tmp_path / "in").mkdir()
    step = -(-len(rows) // files)
    for n in range(files):
        part = rows[n * step : (n + 1) * step]
        spark.createDataFrame(part, "item_id string, record_type string, submission_item string, s long").select("item_id", "record_type", "submission_item", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.02)
    stream = spark.readStream.schema(SLOW).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = awaiting.start(awaiting.released_posts(stream, "12 hours"), f"{tmp_path}/out", f"{tmp_path}/ckpt")
    assert q.awaitTermination(300) and not q.exception()
    got = {}
    for r in spark.read.schema(awaiting.RELEASED).parquet(f"{tmp_path}/out").collect():
        name = (r["kind"], r["post"] if r["kind"] == "released" else r["post"] + " " + r["items"][0])
        assert name not in got and r["n"] == len(r["items"])
        got[name] = r["items"]
    assert got == plain_release(rows, 43200) and any(k == "late" for k, _ in got)
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 4  # the last post and its timer alone


@pytest.mark.parametrize("files", [1, 5])
def test_day_caps_do_not_depend_on_batches(spark, tmp_path, files):
    r = random.Random(3)
    rows = [(i, r.choice("ab"), 86400 + r.randrange(5 * 24) * 3600) for i in range(600)] + [(10_000, "a", 40 * 86400)]
    rows = sorted(rows, key=lambda x: x[2] // 86400) + rows[:5]  # by day, any order within it; some rows twice
    rows = sorted(rows, key=lambda x: x[2] // 86400)
    (tmp_path / "in").mkdir()
    step = -(-len(rows) // files)
    for n in range(files):
        spark.createDataFrame(rows[n * step : (n + 1) * step], "event_id long, event_type string, s long").select("event_id", "event_type", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.02)
    stream = spark.readStream.schema("event_id long, event_type string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = awaiting.start(awaiting.day_caps(stream, "event_type", 4, "1 day"), f"{tmp_path}/out", f"{tmp_path}/ckpt")
    assert q.awaitTermination(300) and not q.exception()
    want = set()
    for key in "ab":
        for day in range(1, 6):
            mine = sorted({(-s, i) for i, k, s in rows if k == key and s // 86400 == day})[:4]
            want |= {(key, day, i) for _, i in mine}
    got = [(x["key"], x["day"], x["id"]) for x in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 4
    held = max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress)
    assert held <= 2 * 5 * (4 + 3)  # rows and timers of open days


def test_day_counts_wait_for_the_horizon(spark, tmp_path):
    rows = [("2024-01-01 10:00:00", "x"), ("2024-01-01 12:00:00", "x"), ("2024-01-02 10:00:00", "y"), ("2024-01-06 10:00:00", "x")]
    df = spark.createDataFrame(rows, "t string, event_type string").select(F.to_timestamp("t").alias("ts"), "event_type")
    df.coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "e"))
    assert sorted((str(d), k, n) for d, k, n in drain(ingest.day_counts(stream), "days")) == [("2024-01-01", "x", 2), ("2024-01-02", "y", 1)]


def test_comments_join_their_post_within_the_horizon(spark, tmp_path):
    posts = spark.createDataFrame([("p", "2024-01-01 00:00:00")], "item_id string, t string").select("item_id", F.to_timestamp("t").alias("ts"))
    comments = spark.createDataFrame([("c1", "p", "2024-01-01 05:00:00"), ("c2", "p", "2024-01-09 00:00:00"), ("c3", "q", "2024-01-01 05:00:00")], "cid string, submission_item string, t string").select("cid", "submission_item", F.to_timestamp("t").alias("ts"))
    posts.write.parquet(str(tmp_path / "p"))
    comments.write.parquet(str(tmp_path / "c"))
    read = lambda df, d: spark.readStream.schema(df.schema).parquet(str(tmp_path / d))
    assert [r[0] for r in drain(ingest.comments_of_posts(read(posts, "p"), read(comments, "c")).select("cid"), "joined")] == ["c1"]


def test_once_within_watermark(spark, tmp_path):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:01"), ("b", "2024-01-01 00:00:02")], "k string, t string").select("k", F.to_timestamp("t").alias("ts"))
    df.write.parquet(str(tmp_path / "o"))
    got = drain(ingest.not_future(ingest.once(spark.readStream.schema(df.schema).parquet(str(tmp_path / "o")), ["k"])).select("k"), "seen")
    assert sorted(r[0] for r in got) == ["a", "b"]
