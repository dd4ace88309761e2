"""Files of text lines by byte offset: reading in stretches (S19, K10), the last lines of the newest file (S19), rewriting in place."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import filesystem, hadoop, listed

STRETCH = 32 << 20
BLOCK = 1 << 20
MARK = "_rewriting.json"
LINE = "file string, offset long, value binary, ending string"


def _lines(source, start: int, end: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(offset, line, its ending) of the lines that begin in [start, end), read in blocks; the last one is read to its end."""
    at, held = start, b""
    if start:
        source.seek(start - 1)
        at = start - 1
        while True:  # the line that holds the byte before belongs to the stretch before
            block = source.read(BLOCK)
            if not block:
                return
            cut = block.find(b"\n")
            if cut >= 0:
                held, at = block[cut + 1 :], at + cut + 1
                break
            at += len(block)
    else:
        source.seek(0)
    pos = 0  # of the line in what is held
    while at < end:
        cut = held.find(b"\n", pos)
        if cut < 0:
            held, pos = held[pos:], 0
            grown = [held]
            while block := source.read(BLOCK):
                grown.append(block)
                if b"\n" in block:
                    break
            held = b"".join(grown)
            cut = held.find(b"\n")
        stop = cut if cut >= 0 else len(held)
        if cut < 0 and stop == pos:
            return
        line, ending = held[pos:stop], b"\n" if cut >= 0 else b""
        size = len(line) + len(ending)
        if ending and line.endswith(b"\r"):
            line, ending = line[:-1], b"\r\n"
        yield at, line, ending
        at, pos = at + size, pos + size


def _read(batches):
    for b in batches:
        for r in b.to_pylist():
            fs, path = filesystem(r["file"])
            rows, size = [], 0
            with fs.open_input_file(path) as source:
                for offset, line, ending in _lines(source, r["start"], r["end"]):
                    rows.append({"file": r["file"], "offset": offset, "value": line, "ending": ending.decode()})
                    size += len(line)
                    if size > 4 << 20 or len(rows) > 10_000:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _ARROW)


_ARROW = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("value", pa.binary()), ("ending", pa.string())])


def lines(spark: SparkSession, path: str, stretch: int = STRETCH, suffixes: tuple[str, ...] = (".json", ".jsonl")) -> DataFrame:
    """file, offset, value (bytes without the ending), ending, of the files below a folder; a large file is read by many tasks."""
    parts = [(f, a, min(a + stretch, n)) for f, n, _ in listed(spark, path) if f.endswith(suffixes) for a in range(0, n, stretch)]
    if not parts:
        return spark.createDataFrame([], LINE)
    return spark.createDataFrame(parts, "file string, start long, end long").repartition(min(len(parts), 10_000)).mapInArrow(_read, LINE)


def tail(spark: SparkSession, path: str, n: int, block: int = 1 << 16) -> DataFrame:
    """File, back, value: the last n lines of the file written last, the last one first. Names and times choose the file; it is read from its end, in blocks, until there are n lines."""
    found = listed(spark, path)
    if not found or n < 1:
        return spark.createDataFrame([], "file string, back int, value string")
    file, size, _ = max(found, key=lambda x: (x[2], x[0]))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                fs, at_path = filesystem(r["file"])
                with fs.open_input_file(at_path) as source:
                    start, held = r["size"], b""
                    while start and held[:-1].count(b"\n") < n:  # the last byte may end the last line
                        step = min(block, start)
                        start -= step
                        source.seek(start)
                        held = source.read(step) + held
                rows = held.split(b"\n")
                if rows and not rows[-1]:
                    rows.pop()
                last = [x.removesuffix(b"\r").decode("utf-8", "replace") for x in rows[::-1][:n]]
                yield pa.RecordBatch.from_arrays([pa.array([r["file"]] * len(last)), pa.array(range(len(last)), pa.int32()), pa.array(last, pa.string())], names=["file", "back", "value"])

    return spark.createDataFrame([(file, size)], "file string, size long").mapInArrow(run, "file string, back int, value string")


def edited(found: DataFrame, change: Callable[[dict], dict | None]) -> DataFrame:
    """Of lines() those that hold a JSON object which `change` alters, with `new` (null: the line goes). Lines that are no object stay."""

    def run(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                try:
                    old = json.loads(r["value"])
                except ValueError:
                    continue
                if isinstance(old, dict) and (new := change(dict(old))) != old:
                    rows.append(r | {"new": None if new is None else json.dumps(new, ensure_ascii=False)})
            yield pa.RecordBatch.from_pylist(rows, _ARROW.append(pa.field("new", pa.string())))

    return found.mapInArrow(run, LINE + ", new string")


def without_author(record: dict) -> dict:
    """Names go, pseudonyms stay."""
    record.pop("author", None)
    return record


def retagged(record: dict) -> dict:
    """A calendar walk's tag is natural."""
    day = record.get("matched_query_or_keyword")
    if record.get("sampling_strategy") == "keyword_oversampled" and isinstance(day, str) and re.fullmatch(r"\d{4}-\d{2}-\d{2}", day):
        record |= {"sampling_strategy": "natural", "matched_query_or_keyword": None}
    return record


def _stage(run_id: str):
    """Changes by file and offset, in order -> file, staged: each changed file's new copy beside it. One file's changes come to one task, as
    a stream that meets the file's bytes; neither is held."""

    def work(batches):
        from pyspark import TaskContext

        def changes() -> Iterator[tuple[str, int, int, bytes]]:
            for b in batches:
                yield from zip(b.column("file").to_pylist(), b.column("offset").to_pylist(), b.column("size").to_pylist(), b.column("new").to_pylist(), strict=True)

        attempt = TaskContext.get().taskAttemptId()
        done, file, source, out, at = [], None, None, None, 0

        def copy(upto: int | None) -> None:
            nonlocal at
            while upto is None or at < upto:
                block = source.read(BLOCK if upto is None else min(BLOCK, upto - at))
                if not block:
                    return
                out.write(block)
                at += len(block)

        def finish() -> None:
            if file is not None:
                copy(None)
                source.close()
                out.close()

        for name, offset, size, new in changes():
            if name != file:
                finish()
                file, at = name, 0
                fs, path = filesystem(name)
                folder, _, last = path.rpartition("/")
                staged = f"{name.rpartition('/')[0]}/.{last}.{run_id}-{attempt}"
                source, out = fs.open_input_file(path), fs.open_output_stream(f"{folder}/.{last}.{run_id}-{attempt}")
                done.append((name, staged))
            copy(offset)
            out.write(new)
            source.seek(offset + size)
            at = offset + size
        finish()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done]), pa.array([x for _, x in done])], names=["file", "staged"])

    return work


def rewrite(spark: SparkSession, path: str, changed: DataFrame, stop_after: str | None = None) -> list[str]:
    """Files below `path` with some lines replaced, all other bytes as they were. changed(file, offset, value, new): of lines() the
    rows to replace, with their new text; a null drops the line. The names of the files that were rewritten.

    New copies are staged first, under names that readers skip; then a mark lists them; then each is renamed into its place. A run that
    dies before the mark leaves the old files, one that dies after it is finished by `recover`, which each run calls first. `stop_after`
    (`staged`, `marked`, `first`) ends a run there, for tests.
    """
    recover(spark, path)
    run_id = uuid.uuid4().hex
    size = F.octet_length("value") + F.octet_length("ending")
    new = F.when(F.col("new").isNull(), F.lit(b"")).otherwise(F.concat(F.col("new").cast("binary"), F.col("ending").cast("binary")))
    rows = changed.select("file", "offset", size.cast("bigint").alias("size"), new.alias("new"))
    staged = rows.repartition("file").sortWithinPartitions("file", "offset").mapInArrow(_stage(run_id), "file string, staged string").collect()  # names of changed files
    if stop_after == "staged":
        return []
    fs, top = hadoop(spark, path)
    text = json.dumps([[r["file"], r["staged"]] for r in sorted(staged)])
    mark, draft = hadoop(spark, f"{path.rstrip('/')}/{MARK}")[1], hadoop(spark, f"{path.rstrip('/')}/.{run_id}")[1]
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.rename(draft, mark)
    if stop_after == "marked":
        return []
    return recover(spark, path, stop_after == "first")


def recover(spark: SparkSession, path: str, only_first: bool = False) -> list[str]:
    """Finish what a mark says; without one, forget staged copies that no mark names."""
    fs, top = hadoop(spark, path)
    mark = hadoop(spark, f"{path.rstrip('/')}/{MARK}")[1]
    if not fs.exists(mark):
        it = fs.listFiles(top, True) if fs.exists(top) else None
        while it is not None and it.hasNext():
            p = it.next().getPath()
            if p.getName().startswith(".") and (".json." in p.getName() or ".jsonl." in p.getName()):
                fs.delete(p, False)
        return []
    stream = fs.open(mark)
    try:
        pairs = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    over = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
    over[0] = jvm.Options.Rename.OVERWRITE
    place = jvm.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    for file, staged in pairs:
        old, new = hadoop(spark, file)[1], hadoop(spark, staged)[1]
        if fs.exists(new):  # else it is in its place already
            sums = jvm.Path(old.getParent(), f".{old.getName()}.crc")  # a local file system keeps sums of the old bytes beside them
            if fs.exists(sums):
                fs.delete(sums, False)
            place.rename(fs.makeQualified(new), fs.makeQualified(old), over)
        if only_first:
            return []
    fs.delete(mark, False)
    return [f for f, _ in pairs]
