"""A folder as one zip file, deflated and summed in tasks.

Files are cut into pieces; a task deflates a piece on its own and takes its CRC. Deflate streams of pieces that end on a flush follow one
another as one stream, and CRCs combine by their lengths, so the driver needs the pieces' numbers only: from them it writes
each file's header and the directory (ZIP64 where a size or place doesn't fit 32 bits). The file system joins headers and pieces: by `concat` where it has
that, else by copying in small blocks.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..scratch import filesystem, hadoop, listed

PIECE = 64 << 20
BLOCK = 4 << 20
SMALL = 0xFFFFFFFF
SUMS = "SHA256SUMS.txt"


def crc_joined(a: int, b: int, length: int) -> int:
    """The CRC-32 of two stretches from theirs and the second's length: `length` zero bytes put behind the first, by squaring the step of one bit (a matrix over two elements)."""

    def times(m: list[int], v: int) -> int:
        out, i = 0, 0
        while v:
            if v & 1:
                out ^= m[i]
            v >>= 1
            i += 1
        return out

    if not length:
        return a
    step = [0xEDB88320] + [1 << n for n in range(31)]  # one zero bit
    for _ in range(3):  # one zero byte
        step = [times(step, x) for x in step]
    while length:
        if length & 1:
            a = times(step, a)
        step = [times(step, x) for x in step]
        length >>= 1
    return a ^ b


def _blocks(stream, start: int, size: int) -> Iterator[bytes]:
    stream.seek(start)
    while size and (block := stream.read(min(BLOCK, size))):
        size -= len(block)
        yield block


_PIECE = pa.schema([("file_no", pa.int32()), ("n", pa.int32()), ("crc", pa.int64()), ("size", pa.int64()), ("deflated", pa.int64()), ("to", pa.string())])
_SUM = pa.schema([("file_no", pa.int32()), ("sha256", pa.string())])


def _deflate(batches):
    """(file, n, start, size, last, to) -> the same n with CRC and lengths; the deflated piece is at `to`."""
    for b in batches:
        for r in b.to_pylist():
            fs, path = filesystem(r["file"])
            out_fs, to = filesystem(r["to"])
            crc, made, squeeze = 0, 0, zlib.compressobj(6, zlib.DEFLATED, -15)
            with fs.open_input_file(path) as source, out_fs.open_output_stream(to) as out:
                for block in _blocks(source, r["start"], r["size"]):
                    crc = zlib.crc32(block, crc)
                    made += out.write(squeeze.compress(block))
                made += out.write(squeeze.flush(zlib.Z_FINISH if r["last"] else zlib.Z_FULL_FLUSH))
            yield pa.RecordBatch.from_pylist([{"file_no": r["file_no"], "n": r["n"], "crc": crc, "size": r["size"], "deflated": made, "to": r["to"]}], _PIECE)


def _digest(batches):
    for b in batches:
        for r in b.to_pylist():
            fs, path = filesystem(r["file"])
            sha = hashlib.sha256()
            with fs.open_input_file(path) as source:
                for block in _blocks(source, 0, r["size"]):
                    sha.update(block)
            yield pa.RecordBatch.from_pylist([{"file_no": r["file_no"], "sha256": sha.hexdigest()}], _SUM)


def _tasks(spark: SparkSession, rows: list[tuple], kind: str) -> DataFrame:
    return spark.createDataFrame(rows, kind).repartition(max(1, min(len(rows), 10_000)))


class Entry:
    """One file of the zip: its name, CRC, lengths and place."""

    def __init__(self, name: str, crc: int, size: int, deflated: int, at: int):
        self.name, self.crc, self.size, self.deflated, self.at = name.encode(), crc, size, deflated, at

    def header(self, small: int = SMALL) -> bytes:
        wide = max(self.size, self.deflated) >= small
        extra = struct.pack("<HHQQ", 1, 16, self.size, self.deflated) if wide else b""
        sizes = (SMALL, SMALL) if wide else (self.deflated, self.size)
        return struct.pack("<IHHHHHIIIHH", 0x04034B50, 45 if wide else 20, 0x800, 8, 0, 33, self.crc, *sizes, len(self.name), len(extra)) + self.name + extra

    def directory(self, small: int = SMALL) -> bytes:
        wide = max(self.size, self.deflated) >= small
        far = self.at >= small
        fields = ([self.size, self.deflated] if wide else []) + ([self.at] if far else [])
        extra = struct.pack(f"<HH{len(fields)}Q", 1, 8 * len(fields), *fields) if fields else b""
        sizes = (SMALL, SMALL) if wide else (self.deflated, self.size)
        version = 45 if fields else 20
        return struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, version, version, 0x800, 8, 0, 33, self.crc, *sizes, len(self.name), len(extra), 0, 0, 0, 0, SMALL if far else self.at) + self.name + extra


def ending(entries: list[Entry], at: int, small: int = SMALL) -> bytes:
    """The directory and what points to it."""
    rows = b"".join(e.directory(small) for e in entries)
    out, n = rows, len(entries)
    if n >= min(small, 0xFFFF) or len(rows) >= small or at >= small:
        out += struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, len(rows), at) + struct.pack("<IIQI", 0x07064B50, 0, at + len(rows), 1)
        return out + struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, SMALL, SMALL, 0)
    return out + struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, n, n, len(rows), at, 0)


def zipped(spark: SparkSession, folder: str, to: str, piece: int = PIECE, small: int = SMALL) -> str:
    """All files below the folder in one zip at `to`, with SHA256SUMS.txt; it appears whole or not at all. `small`: the first length that gets ZIP64 fields."""
    fs, top = hadoop(spark, folder)
    base = fs.makeQualified(top).toString().rstrip("/") + "/"
    found = [(i, file, size, file.removeprefix(base)) for i, (file, size, _) in enumerate(listed(spark, folder))]
    staged = f"{to}.parts-{uuid.uuid4().hex}"
    out_fs, out_path = hadoop(spark, to)
    out_fs.mkdirs(hadoop(spark, staged)[1])
    pieces = [(i, n, file, start, min(piece, size - start), start + piece >= size, f"{staged}/{i}-{n}") for i, file, size, _ in found for n, start in enumerate(range(0, max(size, 1), piece))]
    made: dict[int, list] = {}
    if found:
        kind = "file_no int, n int, file string, start long, size long, last boolean, to string"
        rows = _tasks(spark, pieces, kind).mapInArrow(_deflate, "file_no int, n int, crc long, size long, deflated long, to string").collect()  # numbers of pieces
        for r in sorted(rows, key=lambda r: (r["file_no"], r["n"])):
            made.setdefault(r["file_no"], []).append(r)
    sums = _tasks(spark, [(i, file, size) for i, file, size, _ in found], "file_no int, file string, size long").mapInArrow(_digest, "file_no int, sha256 string").collect() if found else []
    digest = {r["file_no"]: r["sha256"] for r in sums}
    parts, entries, at = [], [], 0

    def put(name: str, content: bytes) -> None:
        nonlocal at
        stream = out_fs.create(hadoop(spark, f"{staged}/{name}")[1], True)
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()
        parts.append(f"{staged}/{name}")
        at += len(content)

    for i, _, _, name in found:
        crc, size, deflated = 0, 0, 0
        for r in made[i]:
            crc, size, deflated = crc_joined(crc, r["crc"], r["size"]), size + r["size"], deflated + r["deflated"]
        entries.append(Entry(name, crc, size, deflated, at))
        put(f"{i}-header", entries[-1].header(small))
        parts += [r["to"] for r in made[i]]
        at += deflated
    text = "".join(f"{digest[i]}  {name}\n" for i, _, _, name in found).encode()
    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
    flat = squeeze.compress(text) + squeeze.flush()
    entries.append(Entry(SUMS, zlib.crc32(text), len(text), len(flat), at))
    put("sums", entries[-1].header(small) + flat)
    put("directory", ending(entries, at, small))
    _join(spark, out_fs, f"{staged}/whole", parts)
    out_fs.delete(out_path, False)
    out_fs.rename(hadoop(spark, f"{staged}/whole")[1], out_path)
    out_fs.delete(hadoop(spark, staged)[1], True)
    return to


def _join(spark: SparkSession, fs, whole: str, parts: list[str]) -> None:
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    target = hadoop(spark, whole)[1]
    fs.create(target, True).close()
    paths = [hadoop(spark, p)[1] for p in parts]
    try:
        array = gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(paths))
        for i, p in enumerate(paths):
            array[i] = p
        fs.concat(target, array)
        return
    except Exception as e:  # noqa: BLE001
        if "Unsupported" not in str(e) and "not supported" not in str(e).lower() and "Not implemented" not in str(e):
            raise
    out = fs.create(target, True)
    try:
        for p in paths:
            source = fs.open(p)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
            finally:
                source.close()
    finally:
        out.close()
