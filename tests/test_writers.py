import json

from pyspark.sql import functions as F

from threadloom.functions import text
from threadloom.operators import export, state, views
from threadloom.schemas import MANIFEST
from threadloom.sources import files
from threadloom.workspace import Workspace


def test_records_by_subreddit_and_day(spark, tmp_path):
    r = spark.createDataFrame([("t3_a", "s1", "2026-08-20T10:00:00Z"), ("t3_b", "s2", "2026-08-21T00:00:00Z")], "reddit_fullname string, subreddit string, retrieved_at_utc string")
    files.write_records(r, str(tmp_path / "raw"))
    files.write_records(r, str(tmp_path / "raw"))
    assert (tmp_path / "raw/subreddit=s1/collected_date=2026-08-20").is_dir()
    assert spark.read.json(str(tmp_path / "raw")).count() == 4


def test_manifests_and_runs(spark, tmp_path):
    (tmp_path / "m").mkdir()
    for k, at in (("run-aaaaaaaa", "2026-01-01"), ("b", "2026-02-01")):
        (tmp_path / f"m/{k}.json").write_text(json.dumps({"collection_run_id": k, "started_at_utc": at, "errors": ["x"]}))
    (tmp_path / "m/bad.json").write_text("{")
    got = files.manifests(spark, str(tmp_path / "m"))
    assert got.count() == 2 and set(got.columns) == set(MANIFEST.names)
    assert [r["run"] for r in views.runs(got).collect()] == ["b", "run-aaaa…"]
    files.write_manifest(got.limit(1), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_csv(spark, tmp_path):
    files.write_csv(spark.createDataFrame([(1, "a,b")], "n int, t string"), str(tmp_path / "csv"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).first()["t"] == "a,b"


def test_checksums(spark, tmp_path):
    import hashlib

    (tmp_path / "f.bin").write_bytes(b"abc")
    assert [tuple(r) for r in export.checksums(spark, str(tmp_path / "f.bin")).collect()] == [("f.bin", hashlib.sha256(b"abc").hexdigest())]


def test_failures_and_queue(spark):
    f = spark.createDataFrame([("a", "m", "v", "annotator", "e" * 3000), ("b", "m", "v", "annotator", "x")], "item_id string, model_key string, prompt_version string, role string, error string")
    assert max(len(r["error"]) for r in state.failure(f).collect()) == 2000
    assert state.cleared(f, "m", "v", "annotator").count() == 0 and state.cleared(f, "m", "v", "other").count() == 2


def test_intervals(spark):
    spans = F.array(*(F.struct(F.lit(a).alias("lo"), F.lit(b).alias("hi")) for a, b in ((5, 8), (0, 2), (2, 3), (6, 7), (9, 9))))
    got = spark.range(1).select(text.merged_intervals(spans).alias("m")).first()["m"]
    assert [(r["lo"], r["hi"]) for r in got] == [(0, 3), (5, 8), (9, 9)]


def test_workspace_versions(spark, tmp_path):
    w = Workspace(spark, str(tmp_path / "w"))
    assert not w.has("t") and w.table("t", "a int").count() == 0
    for n in range(4):
        w.save("t", spark.range(n))
    assert w.table("t").count() == 3 and w.versions("t") == [2, 3]
    (tmp_path / "w/t/9").mkdir()  # a save that did not finish
    assert w.table("t").count() == 3
    assert w.save("t", w.table("t").filter("id > 0")).count() == 2
