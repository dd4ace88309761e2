"""Shared pieces: Arrow slices, word spans and hashes over bytes, packed blobs, tables in the shared folder."""

from __future__ import annotations

import contextlib
import pickle
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these; the same class in Java, Python and DuckDB patterns.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs_of(df: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and the named columns alone, typed; other columns of the input can't clash. Rows without a doc_id are left out: no result could name them."""
    kinds = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string"}
    return df.select(*(F.col(c).cast(kinds[c]).alias(c) for c in ("doc_id", "text", *more))).filter("doc_id IS NOT NULL")


def crc_mod(col: str, m: int):
    """crc32 of the number's decimal text, modulo m."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % m


def bound_batches(spark: SparkSession, mb: int = 8) -> None:
    """Arrow batches by bytes, not by rows alone: very long texts must not pile up in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


def shared_dir(spark: SparkSession) -> str:
    """A new folder that the driver and all executors see: under spark.checkpoint.dir. Where that is unset, a local one will do for a local master; a cluster's executors would not see each other's files there, so there it is an error."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.gettempdir() + "/threadloom"
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str, name: str, *by: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: its lineage ends here, and a lost executor costs a reread."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Remove a table of the shared folder that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def shared_files(spark: SparkSession, path: str) -> list[str]:
    """The data files of a folder in the shared one, by name."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().toString() for f in fs.listStatus(p) if f.getPath().getName().endswith(".parquet")) if fs.exists(p) else []


@contextlib.contextmanager
def shared_file(uri: str):
    """In a Python worker: a file of the shared folder, open for reading. `s3a` is Hadoop's name for what Arrow calls `s3`."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if scheme == "file" or not rest:
        at, path = fs.LocalFileSystem(), "/" + (rest or uri).lstrip("/")
    else:
        at, path = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}")
    with at.open_input_file(path) as f:
        yield f


@lru_cache(1)
def lean() -> None:
    """In a Python worker: what arrays free goes back to the system, so idle workers stay small beside the busy ones."""
    import ctypes

    pa.set_memory_pool(pa.system_memory_pool())
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD, else it grows with what is freed


def give_back() -> None:
    """In a Python worker, at a task's end: what is free goes back to the system, as the worker may idle beside the next stage's."""
    import ctypes
    import gc

    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def input_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, from file sizes for a scan; 0 where it has none (it then says the largest number)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 56 else 0


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts, counted: what groups are held whole in a task is sized by them, not by an estimate or the session's settings."""
    return int(docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0)


def groups(size: int, each: int, least: int) -> int:
    """So many groups that one holds about `each` of the bytes, `least` of them anyway."""
    return max(least, -(-size // each))


def heavy(counts: DataFrame, rows: int, share: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """counts(hash, n): hashes with `share` of `rows` or more, ascending, and their counts; the `most` largest at most. A plan's hint only: whoever gets it has an exact way for all others."""
    some = counts.groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= F.lit(max(2.0, share * rows)))
    got = some.orderBy(F.desc("n"), "hash").limit(most).toArrow()
    hashes, n = got.column("hash").to_numpy().view(U64), got.column("n").to_numpy()
    order = np.argsort(hashes)
    return hashes[order], n[order]


class Tally:
    """Of hashes that come slice by slice, those with a share of a slice's rows: what may be heavy in all."""

    def __init__(self, share: float, room: int = 1 << 16):
        self.share, self.room, self.found, self.rows = share, room, {}, 0

    def add(self, hashes: np.ndarray, rows: int) -> None:
        """Hashes of a slice of so many rows, each at most once a row."""
        self.rows += rows
        if not len(hashes):
            return
        sorted_ = np.sort(hashes)
        heads = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
        n = np.diff(np.r_[heads, len(sorted_)])
        often = np.flatnonzero(n >= max(3, self.share * rows))
        for h, c in zip(sorted_[heads[often]].view(np.int64).tolist(), n[often].tolist(), strict=True):
            self.found[h] = self.found.get(h, 0) + c
        if len(self.found) > 2 * self.room:
            self.found = dict(sorted(self.found.items(), key=lambda x: -x[1])[: self.room])

    def result(self) -> tuple[list[int], list[int]]:
        """Hashes, and in how many rows of the task they were found, of those with the share of all its rows too."""
        kept = {h: n for h, n in self.found.items() if n >= self.share * self.rows}
        return list(kept), list(kept.values())


def member(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Place of each hash in an ascending list, or -1."""
    if not len(of):
        return np.full(len(hashes), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(of, hashes), len(of) - 1)
    return np.where(of[at] == hashes, at, -1)


def pack(*arrays, level: int = 1) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(arrays, protocol=5))


def unpack(blob: bytes):
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the offsets of its rows in them (a null is empty). No copy beyond the cast."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if len(offsets) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 2 << 20):
    """Parts of a batch of at most so many text bytes (one text at least), so that arrays over bytes stay small."""
    if not batch.num_rows:
        return
    lengths = np.diff(byte_view(batch.column(batch.schema.get_field_index(column)))[1])
    group = np.cumsum(lengths) // most
    cuts = np.flatnonzero(np.diff(group)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(lo, hi - lo)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that lie end to end, and where each text's words begin (one more entry than texts)."""
    inside = ~_IS_SPACE[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    before[heads] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    tails = offsets[1:][np.diff(offsets) > 0] - 1
    after[tails] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            x = np.full(n, base, dtype=U64)
            x[0] = 1
            _POWERS[name] = np.cumprod(x)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = 1 << 19) -> np.ndarray:
    """A 64-bit hash of each word's bytes, from prefix sums; done in stretches, so memory doesn't follow the text's length."""
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + most, side="right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _powers(max(hi - lo + 1, most + 1))
        sums = np.zeros(hi - lo + 1, dtype=U64)
        np.cumsum((data[lo:hi].astype(U64) + U64(1)) * up[: hi - lo], out=sums[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[b] - sums[a]) * down[a] + (b - a).astype(U64) * U64(0xD6E8FEB86659FD93)
        i = j
    return mix(out)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, ... of each run, end to end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    at = np.cumsum(lengths) - lengths
    kind = np.int32 if total < 1 << 31 and int(starts.max()) + total < 1 << 31 else np.int64
    out = np.repeat((starts - at).astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out


def binary_rows(offsets: np.ndarray, data: bytes | np.ndarray) -> pa.Array:
    """A binary column whose rows are the stretches between the offsets."""
    raw = data if isinstance(data, bytes) else np.ascontiguousarray(data).tobytes()
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64).tobytes()), pa.py_buffer(raw)]).cast(pa.binary())
