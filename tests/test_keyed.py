"""Keyed tables: reads equal the plain upsert, writes cost what they change, writers don't lose one another's rows."""

import os
import random

import pytest

from threadloom import keyed
from threadloom.keyed import Conflict, KeyedTable

KIND = "k string, n long, v string"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def table(spark, tmp_path, n=200, buckets=8):
    rows = [(f"k{i}", i % 3, f"v{i}") for i in range(n)]
    return KeyedTable.create(spark.createDataFrame(rows, KIND), str(tmp_path / "t"), ["k", "n"], buckets), {(k, x): v for k, x, v in rows}


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_reads_equal_a_plain_dictionary(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(keyed, "BROADCAST_ROWS", broadcast)
    t, want = table(spark, tmp_path)
    r = random.Random(5)
    for step in range(5):
        some = {(f"k{r.randint(0, 260)}", r.randint(0, 2)): f"step{step}" for _ in range(25)}
        if step == 2:
            t.delete(spark.createDataFrame([(*k, None) for k in some], KIND).select("n", "k"))
            want = {k: v for k, v in want.items() if k not in some}
        elif step == 3:
            t.insert_new(spark.createDataFrame([(*k, v) for k, v in some.items()] + [(*k, "z" + v) for k, v in some.items()], KIND))
            want = some | want
        else:
            t.upsert(spark.createDataFrame([(*k, v) for k, v in some.items()], KIND))
            want |= some
        assert rows_of(t.read()) == sorted((*k, v) for k, v in want.items())
        if step in (1, 3):
            t.compact()
            assert not t.manifest()["deltas"] and rows_of(t.read()) == sorted((*k, v) for k, v in want.items())
    assert rows_of(t.read(0)) == rows_of(table(spark, tmp_path / "again")[0].read())  # an old state is there as long as its files are


def test_an_upsert_writes_its_rows_and_a_compaction_their_buckets(spark, tmp_path):
    t, _ = table(spark, tmp_path, 400)
    before = files(tmp_path)
    t.upsert(spark.createDataFrame([("k7", 1, "new")], KIND).coalesce(1))
    delta = files(tmp_path) - before
    assert before <= files(tmp_path) and len(delta) == 1 and spark.read.parquet(*delta).count() == 1
    base = t.manifest()["base"]
    t.compact()
    now = t.manifest()["base"]
    touched = [b for b in base if now[b] != base[b]]
    assert len(touched) == 1 and len(base) == 8
    assert spark.read.parquet(now[touched[0]]).filter("v = 'new'").count() == 1
    gone = t.vacuum(1)
    assert gone and t.read().count() == 400 and t.read().filter("v = 'new'").count() == 1


def test_writers_do_not_lose_rows(spark, tmp_path):
    t, want = table(spark, tmp_path, 20)
    other = KeyedTable(spark, t.root)
    put, raced = t._put, []

    def late(n, manifest):  # another writer is there first, once
        if not raced:
            raced.append(other.upsert(spark.createDataFrame([("theirs", 1, "b")], KIND)))
        return put(n, manifest)

    t._put = late
    t.upsert(spark.createDataFrame([("mine", 1, "a")], KIND))
    assert t.read().filter("k IN ('mine', 'theirs')").count() == 2 and t.read().count() == 22
    raced.clear()

    def late_too(n, manifest):
        if not raced:
            raced.append(other.upsert(spark.createDataFrame([("new", 5, "theirs")], KIND)))
        return put(n, manifest)

    t._put = late_too
    t.insert_new(spark.createDataFrame([("new", 5, "mine"), ("own", 5, "mine")], KIND))
    assert rows_of(t.read().filter("n = 5")) == [("new", 5, "theirs"), ("own", 5, "mine")]


def test_a_compaction_keeps_later_deltas_and_gives_way(spark, tmp_path):
    t, _ = table(spark, tmp_path, 20)
    t.upsert(spark.createDataFrame([("a", 1, "a")], KIND))
    old = t.manifest()
    t.upsert(spark.createDataFrame([("a", 1, "b")], KIND))
    t.compact(old)  # its deltas are those of then
    assert [d["seq"] for d in t.manifest()["deltas"]] == [2] and rows_of(t.read().filter("k = 'a'")) == [("a", 1, "b")]
    with pytest.raises(Conflict):
        t.compact(old)
    assert rows_of(t.read().filter("k = 'a'")) == [("a", 1, "b")]


def test_a_dead_writer_leaves_the_state_alone(spark, tmp_path):
    t, _ = table(spark, tmp_path, 20)
    state = rows_of(t.read())
    t._write_delta(spark.createDataFrame([("a", 1, "a")], KIND), t.manifest(), False)  # and no commit
    assert rows_of(t.read()) == state
    assert len(t.vacuum()) == 1


def test_bad_changes(spark, tmp_path):
    t, _ = table(spark, tmp_path, 5)
    with pytest.raises(ValueError, match="twice"):
        t.upsert(spark.createDataFrame([("a", 1, "a"), ("a", 1, "b")], KIND))
    with pytest.raises(ValueError, match="null"):
        t.upsert(spark.createDataFrame([(None, 1, "a")], KIND))
    n = t.version()
    assert t.upsert(spark.createDataFrame([], KIND)) == n == t.version()
    with pytest.raises(FileExistsError):
        KeyedTable.create(spark.createDataFrame([], KIND), t.root, ["k"])
    with pytest.raises(FileNotFoundError):
        KeyedTable(spark, str(tmp_path / "none")).read()
    empty = KeyedTable.create(spark.createDataFrame([], KIND), str(tmp_path / "e"), ["k"])
    assert empty.read().count() == 0 and empty.upsert(spark.createDataFrame([("a", 1, "x")], KIND)) == 1 and empty.read().count() == 1
