import json

import pytest

from threadloom import cli
from threadloom.sources import plugin


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("ws")
    (d / "raw").mkdir()
    rows = [{"record_type": "submission", "id": "p", "reddit_fullname": "t3_p", "reddit_id": "p", "subreddit": "s", "title": "A fine title", "selftext": "with a body of words", "author": "Ann", "created_utc": "2026-06-01T00:00:00Z", "is_self": True}]
    rows += [{"record_type": "comment", "reddit_fullname": f"t1_{k}", "reddit_id": str(k), "subreddit": "s", "link_id": "t3_p", "parent_id": "t3_p" if k < 3 else f"t1_{k - 3}", "body": f"comment number {k} says something longer", "author": f"user{k % 2}", "created_utc": f"2026-06-0{1 + k % 9}T01:00:00Z"} for k in range(8)]
    (d / "raw/a.jsonl").write_text("\n".join(map(json.dumps, rows)))
    vote = lambda i, m, s, **x: {"item_id": f"t1_{i}", "model_key": m, "prompt_version": "v1", "role": "annotator", "language": "english", "literal_sentiment": "neutral", "intended_sentiment": "negative", "sarcastic": s, "confidence": 0.8, "cue_hyperbole": 1, "rationale": "r", **x}
    (d / "votes.json").write_text("\n".join(json.dumps(vote(i, m, int(i % 3 == 0 or (i == 4 and m == "a1")))) for i in range(7) for m in ("a1", "a2", "a3")))
    (d / "judge.json").write_text("\n".join(json.dumps(vote(i, "judge", 1, role="evaluator")) for i in range(7)))
    (d / "reviews.json").write_text("\n".join(json.dumps({"item_id": f"t1_{i}", "sarcastic": int(i % 2 == 0), "language": "english", "literal_sentiment": "neutral", "intended_sentiment": "negative", "is_gold": 1, "votes_seen": 0}) for i in range(4)))
    return d


def test_from_raw_rows_to_the_dataset(spark, work, monkeypatch):
    monkeypatch.setenv("AUTHOR_HMAC_KEY", "secret")
    ws = str(work / "ws")
    go = lambda *a: cli.run(spark, [ws, *map(str, a)])
    count = lambda rows, k: {r[k]: r["n"] for r in rows}
    assert count(go("collect", "--input", work / "raw"), "record_type") == {"submission": 1, "comment": 8}
    assert count(go("collect", "--input", work / "raw"), "record_type") == {"submission": 1, "comment": 8}
    assert go("index") == [{"total": 9, "submissions": 1, "comments": 8}]
    assert count(go("select"), "reason") == {"eligible": 9}
    assert sum(count(go("lid"), "language").values()) == 9 == sum(count(go("lid"), "language").values())
    assert go("contexts") == [{"contexts": 9}]
    assert count(go("load-votes", "--input", work / "votes.json"), "model_key") == {"a1": 7, "a2": 7, "a3": 7}
    assert count(go("load-votes", "--input", work / "votes.json"), "model_key") == {"a1": 7, "a2": 7, "a3": 7}
    go("load-votes", "--input", work / "judge.json", "--into", "evaluations")
    assert count(go("aggregate"), "resolution") == {"unanimous": 6, "unresolved": 1}
    assert count(go("aggregate", "--rule", "majority"), "resolution") == {"unanimous": 6, "majority": 1}
    assert {r["label"]: r["n_items"] for r in go("agreement-report")}["sarcastic"] == 7
    assert count(go("gold-sample", "--size", 4), "bucket") == {"gold": 4} == count(go("gold-sample", "--size", 4), "bucket")
    go("load-reviews", "--input", work / "reviews.json")
    report = {r["source"]: r for r in go("eval-report")}
    assert report["judge"]["n"] == 4 and report["judge"]["kind"] == "evaluator" and report["shipped final"]["n"] == 4
    assert {r["model_key"]: r["pending"] for r in go("status")} == {"a1": 2, "a2": 2, "a3": 2, "senior": None}
    assert {r["in_target"] for r in go("target-progress", "--size", 5)} == {5}
    out = go("export-dataset", "--to", work / "out", "--dataset-version", "d1")
    assert out[0]["exported_rows"] == 7
    shipped = [json.loads(x) for p in (work / "out/d1/dataset_json").glob("*.json") for x in p.read_text().splitlines()]
    assert len(shipped) == 7 and "Ann" not in json.dumps(shipped) and "user1" not in json.dumps(shipped)
    assert all("judge" not in json.dumps(r) for r in shipped)
    assert count(go("fork", "--to", work / "fork", "--extend", "2026-06=1"), "priority") == {2: 7, 1: 1}
    assert go("retag-calendar-walk") == [] and go("scrub-authors") == [{"records": 9}]


def test_no_key_no_records(spark, work, monkeypatch):
    monkeypatch.delenv("AUTHOR_HMAC_KEY", raising=False)
    with pytest.raises(SystemExit):
        cli.run(spark, [str(work / "other"), "collect", "--input", str(work / "raw")])


def test_feed_plugin(spark):
    class Counting:
        schema = "id string, day string"

        def rows(self, day, options):
            for k in range(day.day % 3):
                yield f"{options['name']}{k}", day.isoformat()

    spark.dataSource.register(plugin.source_of("counting", Counting()))
    got = spark.read.format("counting").options(name="x", start="2026-06-05", end="2026-06-01").load().collect()
    assert sorted((r["day"][-1], r["id"]) for r in got) == [("1", "x0"), ("2", "x0"), ("2", "x1"), ("4", "x0"), ("5", "x0"), ("5", "x1")]
