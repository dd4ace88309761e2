import json
import os

from threadloom.operators import corpus
from threadloom.sources import files, indexed


def rec(i, kind="comment", sub="s"):
    return json.dumps({"record_type": kind, "reddit_fullname": f"t1_{i}", "subreddit": sub, "created_utc": f"2026-06-{1 + i % 28:02}T00:00:00Z"})


def put(path, rows, at):
    path.write_text("\n".join(rows) + "\n")
    os.utime(path, (at, at))


def test_only_changed_files_are_read(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    (raw / "sub").mkdir(parents=True)
    put(raw / "a b.jsonl", [rec(i) for i in range(10)] + ["broken", rec(3)], 100)
    put(raw / "sub/b.json", [rec(i, "submission", "t") for i in range(8, 14)], 100)
    put(raw / "c.jsonl", [rec(20)], 100)
    index = indexed.FileIndex(spark, str(raw), str(tmp_path / "index"))
    opened = []
    read = files.jsonl
    monkeypatch.setattr(files, "jsonl", lambda s, p, unique=True: opened.append([os.path.basename(x) for x in p]) or read(s, p, unique))

    def same_as_a_full_run():
        fresh = indexed.FileIndex(spark, str(raw), str(tmp_path / f"full{len(opened)}"))
        fresh.refresh()
        opened.pop()
        key = lambda rows: sorted(tuple(r) for r in rows.collect())
        assert key(index.items()) == key(fresh.items())
        assert key(corpus.subreddit_stats(index.items())) == key(corpus.subreddit_stats(fresh.items()))
        assert corpus.counts(index.items()).first() == corpus.counts(fresh.items()).first()

    assert sorted(os.path.basename(f) for f in index.refresh()["read"]) == ["a b.jsonl", "b.json", "c.jsonl"]
    assert corpus.counts(index.items()).first()["total"] == 15  # 8 and 9 are in two files
    same_as_a_full_run()
    assert index.refresh() == {"read": [], "gone": []} and len(opened) == 1
    put(raw / "a b.jsonl", [rec(i) for i in range(5)], 200)  # shrinks: its part of 8 and 9 goes, the other file's stays
    put(raw / "d.jsonl", [rec(30), rec(0, sub="other")], 200)
    (raw / "c.jsonl").unlink()
    done = index.refresh()
    assert [os.path.basename(f) for f in done["read"]] == ["a b.jsonl", "d.jsonl"] == opened[-1] and [os.path.basename(f) for f in done["gone"]] == ["c.jsonl"]
    assert corpus.counts(index.items()).first()["total"] == 5 + 6 + 1
    same_as_a_full_run()
    index.seen.delete(index.seen.read().select("file").filter("file LIKE '%d.jsonl'"))  # as if a refresh had died before its last step
    assert [os.path.basename(f) for f in index.refresh()["read"]] == ["d.jsonl"]
    same_as_a_full_run()
