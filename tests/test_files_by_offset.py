"""Line files by byte offset, rewriting in place, the newest file's tail, zips made in tasks."""

import hashlib
import io
import json
import os
import random
import shutil
import subprocess
import time
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from threadloom.sources import archive, lines
from threadloom.operators import export

ODD = [b'{"a":  1}\r\n', b"\n", b"not json \n", b"\xff\xfe\n", "é漢🙂\r\n".encode(), b"\r\n", b'{"a": 2, "author": "x"}\n', b"x" * 3000 + b"\n", b'{"author": null}']


def tree(path):
    return {os.path.relpath(os.path.join(d, f), path): open(os.path.join(d, f), "rb").read() for d, _, names in os.walk(path) for f in names if not f.endswith(".crc")}


@pytest.fixture()
def raw(tmp_path):
    top = tmp_path / "raw"
    (top / "sub").mkdir(parents=True)
    (top / "a.jsonl").write_bytes(b"".join(ODD))
    (top / "sub/b.json").write_bytes(b"".join([ODD[-1] + b"\n", *reversed(ODD[1:-1]), b'{"a":   1}']))
    (top / "sub/c.jsonl").write_bytes(b'{"plain": 1}\n' * 50)
    (top / "empty.jsonl").write_bytes(b"")
    (top / "other.txt").write_bytes(b'{"author": "y"}\n')
    return str(top)


@pytest.mark.parametrize("stretch", [1, 2, 7, 100, 1 << 20])
def test_lines_in_stretches(spark, raw, stretch, monkeypatch):
    got = {}
    for r in lines.lines(spark, raw, stretch if stretch > 2 else 500 * stretch).collect():
        got.setdefault(os.path.basename(r["file"]), []).append((r["offset"], bytes(r["value"]) + r["ending"].encode()))
    for name in ("a.jsonl", "sub/b.json", "sub/c.jsonl"):
        content = open(f"{raw}/{name}", "rb").read()
        rows = sorted(got.pop(os.path.basename(name)))
        assert b"".join(x for _, x in rows) == content and all(content[o : o + len(x)] == x for o, x in rows)
        assert [x for _, x in rows] == content.splitlines(True) or [x for _, x in rows] == io.BytesIO(content).readlines()
    assert not got


def test_each_cut_of_a_small_file(tmp_path):
    content = b"".join(ODD)[:60] + b"\n\n\r\nend"
    for block in (1, 3, 1000):
        lines.BLOCK, old = block, lines.BLOCK
        try:
            for cut in range(len(content) + 1):
                both = [x for a, z in ((0, cut), (cut, len(content))) for x in lines._lines(io.BytesIO(content), a, z)]
                assert [v + e for _, v, e in both] == io.BytesIO(content).readlines() and all(content[o : o + len(v)] == v for o, v, _ in both), cut
        finally:
            lines.BLOCK = old


def test_rewrite_touches_changed_lines_only(spark, raw):
    before, stamps = tree(raw), {f: os.stat(f"{raw}/{f}").st_mtime_ns for f in tree(raw)}
    done = lines.rewrite(spark, raw, lines.edited(lines.lines(spark, raw, 50), lines.without_author))
    after = tree(raw)
    assert sorted(map(os.path.basename, done)) == ["a.jsonl", "b.json"] and set(after) == set(before)
    for f in before:
        want = b"".join(json.dumps({k: v for k, v in json.loads(x).items() if k != "author"}).encode() + x[len(x.rstrip(b"\r\n")) :] if b"author" in x else x for x in io.BytesIO(before[f]).readlines())
        assert after[f] == (want if f in ("a.jsonl", "sub/b.json") else before[f])
        assert os.stat(f"{raw}/{f}").st_mtime_ns == stamps[f] or f in ("a.jsonl", "sub/b.json")
    assert lines.rewrite(spark, raw, lines.edited(lines.lines(spark, raw), lines.without_author)) == []


@pytest.mark.parametrize("dies", ["staged", "marked", "first"])
def test_a_killed_run_leaves_old_or_new(spark, raw, dies, tmp_path):
    twin = str(tmp_path / "twin")
    shutil.copytree(raw, twin)
    change = lambda at: lines.edited(lines.lines(spark, at), lines.without_author)
    lines.rewrite(spark, twin, change(twin))
    old, new = tree(raw), tree(twin)
    lines.rewrite(spark, raw, change(raw), stop_after=dies)
    now = tree(raw)
    assert all(now[f] in (old[f], new[f]) for f in old)
    assert spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{json,jsonl}").text(raw).count() == 2 * 9 + 50  # staged copies aren't read
    lines.recover(spark, raw)
    assert tree(raw) == (old if dies == "staged" else new)
    lines.rewrite(spark, raw, change(raw))
    assert tree(raw) == new


def test_dropped_and_longer_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_bytes(b'{"n": 1}\n{"n": 2}\r\n{"n": 3}')
    found = lines.lines(spark, str(tmp_path))
    new = F.when(F.col("value") == b'{"n": 2}', F.lit(None)).otherwise("long " * 9)
    lines.rewrite(spark, str(tmp_path), found.filter(F.col("value") != b'{"n": 1}').withColumn("new", new))
    assert (tmp_path / "x.jsonl").read_bytes() == b'{"n": 1}\n' + b"long " * 9  # a dropped line takes its end along
    assert lines.retagged({"sampling_strategy": "keyword_oversampled", "matched_query_or_keyword": "2026-06-01"}) == {"sampling_strategy": "natural", "matched_query_or_keyword": None}


def test_tail_reads_the_end_only(spark, tmp_path):
    (tmp_path / "old.jsonl").write_bytes(b"old\n" * 5)
    big = tmp_path / "sub"
    big.mkdir()
    (big / "new.jsonl").write_bytes(b"\n".join(b"line %d" % i for i in range(100_000)))
    os.utime(tmp_path / "old.jsonl", (1, 1))
    for n, block in ((3, 7), (3, 1 << 16), (20, 64), (1, 1)):
        got = lines.tail(spark, str(tmp_path), n, block).orderBy("back").collect()
        assert [r["value"] for r in got] == [f"line {99_999 - i}" for i in range(n)] and got[0]["file"].endswith("new.jsonl")
    size = os.path.getsize(big / "new.jsonl")
    with open(big / "new.jsonl", "r+b") as f:  # what lies before the last block is never looked at
        f.seek(0)
        f.write(b"\xff" * (size - 70_000))
    assert lines.tail(spark, str(tmp_path), 5).count() == 5
    (big / "new.jsonl").write_bytes(b"a\r\n\nlast\n")
    assert [r["value"] for r in lines.tail(spark, str(tmp_path), 9).orderBy("back").collect()] == ["last", "", "a"]
    assert lines.tail(spark, str(tmp_path / "none"), 3).count() == 0 == lines.tail(spark, str(tmp_path), 0).count()


def test_joined_crcs():
    r = random.Random(1)
    for a, b in ((b"", b""), (b"x", b""), (b"", b"y"), (b"abc" * 50, b"\0" * 33), (r.randbytes(1000), r.randbytes(70_001))):
        assert archive.crc_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@pytest.mark.parametrize(("piece", "small"), [(64 << 20, archive.SMALL), (1000, archive.SMALL), (4096, 50)])  # the last one: ZIP64 throughout
def test_zip_made_in_tasks(spark, tmp_path, piece, small):
    r, top = random.Random(2), tmp_path / "set"
    (top / "rows").mkdir(parents=True)
    content = {"empty.bin": b"", "rows/é漢.json": b'{"x": 1}\n' * 3000, "rows/random": r.randbytes(20_000), "one": b"1"}
    for name, data in content.items():
        (top / name).write_bytes(data)
    (top / "_SUCCESS").write_bytes(b"")
    to = str(tmp_path / "out/dataset-d1.zip")
    archive.zipped(spark, str(top), to, piece, small)
    with zipfile.ZipFile(to) as z:
        assert z.testzip() is None and {n: z.read(n) for n in z.namelist() if n != archive.SUMS} == content
        assert z.read(archive.SUMS).decode().splitlines() == [f"{hashlib.sha256(content[n]).hexdigest()}  {n}" for n in sorted(content, key=lambda n: f"file:{top}/{n}")]
        if small == 50:
            assert z.getinfo("rows/random").create_version == 45
    if shutil.which("unzip"):
        assert subprocess.run(["unzip", "-tq", to], capture_output=True).returncode == 0
    assert [f for f in os.listdir(tmp_path / "out") if not f.startswith(".")] == ["dataset-d1.zip"]
    archive.zipped(spark, str(tmp_path / "nothing"), to)
    assert zipfile.ZipFile(to).namelist() == [archive.SUMS]


def test_newest_bundle(spark, tmp_path):
    (tmp_path / "set").mkdir()
    (tmp_path / "set/a").write_bytes(b"a")
    export.bundle(spark, str(tmp_path / "set"), str(tmp_path / "zips"), "1")
    time.sleep(1.1)
    last = export.bundle(spark, str(tmp_path / "set"), str(tmp_path / "zips"), "0")
    assert export.newest_bundle(spark, str(tmp_path / "zips")).endswith(last)
