"""Operator 7: token ids in wavelet-matrix files, one per shard.

A file holds, for a run of documents in ascending doc_id order, their token ids as a wavelet matrix: one bit-plane for each bit
of an id, highest first, the ids being stably parted by that bit from plane to plane, with a rank directory over each plane. The
planes lie in blocks that are compressed each for itself, so a look at a place opens one block of each plane it passes. From
the file alone a reader gets the token at a place, the count of a token before a place, the place of its k-th occurrence, and whole
documents. Files are rows of a Parquet table with a binary column: Spark's committer writes them, so a lost task leaves no half
file, and any store that Spark reads will do.

Cases: a null or empty text is the end id alone; repeated doc_ids lie side by side, in an order fixed by their text (ties in doc_id);
a very long text is encoded in pieces cut where no token can span, and may fill a shard of its own; other columns, whatever their
names, are not looked at; rows with a null doc_id are left out; an empty table gives no file and an empty result.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, byte_view, docs_of, input_bytes, partitions, ragged, shared_dir, slices

END = 2
MAGIC = b"WVM2"
#: Bits between two entries of the rank directory; ids of a shard from which it is closed.
STEP = 512
SHARD_IDS = 1 << 20
#: Bytes of a plane that are compressed together, and how hard.
BLOCK, LEVEL = 1 << 14, 1
#: Bytes of text encoded together; bytes of chunks in one call's text.
SLICE, PIECE = 8 << 20, 1 << 17
#: Distinct chunks that a worker remembers the ids of.
REMEMBERED = 1_000_000
FILE_ROWS = "part int, shard int, base bigint, docs bigint, ids bigint, file binary"


class Plane:
    """The bytes of a bit-plane, from the compressed blocks of a file: a look at some of them opens no block but theirs."""

    def __init__(self, wide: int, ends: np.ndarray, raw: memoryview):
        self.wide, self.ends, self.raw = wide, ends, raw
        self.held: tuple[int, np.ndarray] = (-1, np.zeros(0, dtype=np.uint8))

    @staticmethod
    def packed(plane: np.ndarray) -> tuple[np.ndarray, bytes]:
        """Where each block ends among the compressed ones, and these. A block that gains nothing stays as it is, which its length shows."""
        press = zstandard.ZstdCompressor(level=LEVEL)
        blocks = [plane[i : i + BLOCK].tobytes() for i in range(0, len(plane), BLOCK)]
        small = [x if len(x) < len(b) else b for b, x in zip(blocks, map(press.compress, blocks), strict=True)]
        return np.cumsum([len(x) for x in small]).astype("<u4"), b"".join(small)

    def block(self, k: int) -> np.ndarray:
        if self.held[0] != k:
            part = self.raw[int(self.ends[k - 1]) if k else 0 : int(self.ends[k])]
            size = min(BLOCK, self.wide - k * BLOCK)
            plain = part if len(part) == size else zstandard.ZstdDecompressor().decompress(part, max_output_size=size)
            self.held = (k, np.frombuffer(plain, dtype=np.uint8))
        return self.held[1]

    def whole(self) -> np.ndarray:
        return np.concatenate([self.block(k) for k in range(len(self.ends))]) if len(self.ends) else np.zeros(0, dtype=np.uint8)

    def __getitem__(self, at):
        if not isinstance(at, slice):
            return self.block(at // BLOCK)[at % BLOCK]
        a, z = at.start or 0, min(self.wide, at.stop)  # STEP divides BLOCK: a directory entry's bytes lie in one block
        return self.block(a // BLOCK)[a % BLOCK : z - a // BLOCK * BLOCK] if a < z else np.zeros(0, dtype=np.uint8)


class WaveletMatrix:
    """Bit-planes with rank and select over a sequence of ids below 2**bits."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        seq = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros, ranks = [], [], []
        for b in range(bits - 1, -1, -1):
            one = (seq >> seq.dtype.type(b)) & seq.dtype.type(1) != 0
            packed = np.packbits(one, bitorder="little")
            planes.append(packed)
            rank = cls._directory(packed)
            ranks.append(rank)
            zeros.append(len(seq) - int(np.count_nonzero(one)))
            seq = np.concatenate([seq[~one], seq[one]])
        return cls(len(ids), planes, zeros, ranks)

    @staticmethod
    def _directory(packed: np.ndarray) -> np.ndarray:
        """Ones before each STEP bits."""
        width = STEP // 8
        padded = np.zeros(-(-len(packed) // width) * width, dtype=np.uint8)
        padded[: len(packed)] = packed
        ones = np.bitwise_count(padded.view(np.uint64)).reshape(-1, width // 8).sum(1, dtype=np.uint32)
        return np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block = i // STEP
        total = int(self.ranks[level][block])
        part = self.planes[level][block * STEP // 8 : -(-i // 8)]
        return total + int(np.unpackbits(part, bitorder="little")[: i - block * STEP].sum()) if i % STEP else total

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) one or zero of a plane."""
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if bit else np.minimum(np.arange(len(ranks)) * STEP, self.n) - ranks
        block = int(np.searchsorted(before, k, side="right")) - 1
        part = np.unpackbits(self.planes[level][block * STEP // 8 : (block + 1) * STEP // 8], bitorder="little")[: self.n - block * STEP]
        return block * STEP + int(np.flatnonzero(part == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        value = 0
        for level in range(len(self.planes)):
            bit = self.planes[level][i >> 3] >> (i & 7) & 1
            ones = self._rank1(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | int(bit)
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        lo, bits = 0, len(self.planes)
        if token >> bits:
            return 0, 0
        for level in range(bits):
            a, b = self._rank1(level, lo), self._rank1(level, i)
            lo, i = (self.zeros[level] + a, self.zeros[level] + b) if token >> (bits - 1 - level) & 1 else (lo - a, i - b)
        return lo, i

    def count(self, token: int, i: int | None = None) -> int:
        """Occurrences of a token among the first i ids."""
        lo, hi = self._range(token, self.n if i is None else i)
        return hi - lo

    def locate(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of a token."""
        lo, hi = self._range(token, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i, bits = lo + k, len(self.planes)
        for level in range(bits - 1, -1, -1):
            bit = token >> (bits - 1 - level) & 1
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids at once: the planes from the lowest up, each parting undone."""
        seq = np.zeros(self.n, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        for b, (packed, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            one = np.unpackbits(packed.whole() if isinstance(packed, Plane) else packed, count=self.n, bitorder="little").view(bool)
            back = np.empty_like(seq)
            back[~one] = seq[:zeros]
            back[one] = seq[zeros:] | seq.dtype.type(1 << b)
            seq = back
        return seq

    def dump(self) -> bytes:
        head = struct.pack("<QI", self.n, len(self.planes)) + np.array(self.zeros, dtype="<u8").tobytes()
        return head + b"".join(r.astype("<u4").tobytes() + ends.tobytes() + raw for r, (ends, raw) in zip(self.ranks, map(Plane.packed, self.planes), strict=True))

    @classmethod
    def load(cls, raw: bytes, at: int = 0) -> WaveletMatrix:
        n, bits = struct.unpack_from("<QI", raw, at)
        at += 12
        zeros = np.frombuffer(raw, "<u8", bits, at).astype(int).tolist()
        at += 8 * bits
        wide = -(-n // 8)
        entries, blocks = -(-wide // (STEP // 8)) + 1, -(-wide // BLOCK)
        planes, ranks = [], []
        for _ in range(bits):
            ranks.append(np.frombuffer(raw, "<u4", entries, at))
            ends = np.frombuffer(raw, "<u4", blocks, at + 4 * entries)
            at += 4 * (entries + blocks)
            size = int(ends[-1]) if blocks else 0
            planes.append(Plane(wide, ends, memoryview(raw)[at : at + size]))
            at += size
        return cls(n, planes, zeros, ranks)


class Shard:
    """A file: doc_ids, where each document starts, and the matrix of the ids."""

    def __init__(self, docs: np.ndarray, starts: np.ndarray, matrix: WaveletMatrix):
        self.docs, self.starts, self.matrix = docs, starts, matrix

    @classmethod
    def build(cls, docs: np.ndarray, lengths: np.ndarray, ids: np.ndarray, bits: int) -> Shard:
        return cls(docs, np.r_[0, np.cumsum(lengths)].astype(np.int64), WaveletMatrix.build(ids, bits))

    def dump(self) -> bytes:
        return MAGIC + struct.pack("<Q", len(self.docs)) + self.docs.astype("<i8").tobytes() + self.starts.astype("<i8").tobytes() + self.matrix.dump()

    @classmethod
    def load(cls, raw: bytes) -> Shard:
        if raw[:4] != MAGIC:
            raise ValueError("not a wavelet-matrix file")
        (n,) = struct.unpack_from("<Q", raw, 4)
        return cls(np.frombuffer(raw, "<i8", n, 12), np.frombuffer(raw, "<i8", n + 1, 12 + 8 * n), WaveletMatrix.load(raw, 12 + 8 * n + 8 * (n + 1)))


class Encoder:
    """The tokenizers library over the distinct chunks of a batch.

    A chunk is a run of white space with what follows up to the next run or to a mark behind a letter. The byte-level pattern
    never joins characters over such a place, so a text's ids are those of its chunks in turn, and equal chunks are encoded once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bits = max(1, int(self.tokenizer.get_vocab_size() - 1).bit_length())
        self.forget()
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        vocabulary = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():  # a byte-level token has one character for each byte
            self.lengths[i] = len(special[i].encode()) if i in special else len(token)
        self.space = np.zeros(256, dtype=bool)
        self.space[[0x20, *range(9, 14)]] = True
        #: A mark behind an ASCII letter or digit begins a token too.
        self.mark, self.letter = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
        self.mark[list(b".,!?;:)%")] = True
        self.letter[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True

    def _apart(self, data: np.ndarray) -> np.ndarray:
        """Whether a text may be cut behind each byte, if white space follows: not behind what may be white space beyond ASCII, nor behind the separators 1C to 1F."""
        out = (data < 0x80) & ~self.space[data] & ~((data >= 0x1C) & (data <= 0x1F))
        out[1:] |= (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
        return out

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks end to end, and how many of each. Those that may stand side by side are encoded as one text,
        and their ids told apart by the tokens' lengths in bytes."""
        data, at = byte_view(chunks)
        sizes = np.diff(at)
        together = self.space[data[at[:-1]]] & self._apart(data)[at[1:] - 1]
        counts = np.zeros(len(sizes), dtype=np.int64)
        side, alone = np.flatnonzero(together), np.flatnonzero(~together)
        ids_of = []
        if len(side):
            text = data[ragged(at[:-1][side], sizes[side])].tobytes()
            ends = np.cumsum(sizes[side])
            cuts = np.r_[0, ends[np.flatnonzero(np.diff(ends // PIECE))], ends[-1]]
            got = self.tokenizer.encode_batch_fast([text[a:z].decode() for a, z in zip(cuts.tolist(), cuts[1:].tolist(), strict=False) if z > a], add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, dtype=np.uint32) for e in got])
            reached = np.cumsum(self.lengths[ids])
            last = np.searchsorted(reached, ends)
            if len(reached) and last[-1] < len(reached) and (reached[last] == ends).all() and reached[-1] == ends[-1]:
                counts[side] = np.diff(np.r_[-1, last])
                ids_of.append((side, ids))
            else:
                alone = np.arange(len(sizes))
        if len(alone):
            raw = data.tobytes()
            got = [e.ids for e in self.tokenizer.encode_batch_fast([raw[at[i] : at[i + 1]].decode() for i in alone.tolist()], add_special_tokens=False)]
            counts[alone] = [len(x) for x in got]
            ids_of.append((alone, np.array([x for e in got for x in e], dtype=np.uint32)))
        out = np.empty(int(counts.sum()), dtype=np.uint32)
        first = np.cumsum(counts) - counts
        for rows, ids in ids_of:
            out[ragged(first[rows], counts[rows])] = ids
        return out, counts

    def _known(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids kept, and where each chunk's begin and how many they are. Chunks of earlier slices are remembered, REMEMBERED at most."""
        names = chunks.to_pylist()
        if len(self.known) > REMEMBERED:
            self.forget()
        of = np.fromiter((self.known.get(x, -1) for x in names), dtype=np.int64, count=len(names))
        new = np.flatnonzero(of < 0)
        if len(new):
            ids, counts = self._chunks(chunks.take(pa.array(new)))
            of[new] = np.arange(len(self.known), len(self.known) + len(new))
            self.known.update(zip((names[i] for i in new.tolist()), of[new].tolist(), strict=True))
            first = np.cumsum(counts) - counts + len(self.flat)
            self.flat, self.first, self.counts = np.concatenate([self.flat, ids]), np.concatenate([self.first, first]), np.concatenate([self.counts, counts])
        return self.flat, self.first[of], self.counts[of]

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.first, self.counts = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each with the end id, and the number of ids of each text."""
        data, offsets = byte_view(texts)
        space = self.space[data]
        cut = space.copy()
        if len(data) > 1:
            cut[1:] &= self._apart(data)[:-1]
            cut[1:] |= self.mark[data[1:]] & self.letter[data[:-1]]
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut)
        if not len(starts):
            return np.full(len(offsets) - 1, END, dtype=np.uint32), np.ones(len(offsets) - 1, dtype=np.int64)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.r_[starts, len(data)].astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).dictionary_encode()
        which = chunks.indices.to_numpy()
        flat, at, lengths = self._known(chunks.dictionary)
        sizes = lengths[which]
        ids = flat[ragged(at[which], sizes)]
        ends = np.r_[0, np.cumsum(sizes)][np.searchsorted(starts, offsets)]
        return np.insert(ids, ends[1:], END), np.diff(ends) + 1


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_shards(documents: DataFrame, tokenizer_file: str, path: str, shard_ids: int = SHARD_IDS) -> None:
    """Encode and write shard files; rows part, shard, base (ids before it in its part), docs, ids, file. Parts are ranges of doc_id, shards follow each other in a part."""
    spark = documents.sparkSession
    bound_batches(spark, 16)
    docs = docs_of(documents)

    def build(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        coder = encoder(tokenizer_file)
        part, shard, base, held, size = TaskContext.get().partitionId(), 0, 0, [], 0

        def close():
            docs, lengths, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            raw = Shard.build(docs, lengths, ids, coder.bits).dump()
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([base], pa.int64()), pa.array([len(docs)], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([raw], pa.binary())], names=["part", "shard", "base", "docs", "ids", "file"])

        for whole in batches:
            for b in slices(whole, most=SLICE):
                ids, lengths = coder.encode(b.column(1))
                held.append((b.column(0).to_numpy(zero_copy_only=False), lengths, ids))
                size += len(ids)
                if size >= shard_ids:
                    yield close()
                    shard, base, held, size = shard + 1, base + size, [], 0
        if held:
            yield close()

    # equal doc_ids stay in one range; sizes from the optimizer's estimate
    parts = max(partitions(spark), -(-input_bytes(docs) // (64 << 20)))
    ordered = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(build, FILE_ROWS).write.mode("overwrite").option("compression", "none").parquet(path)


def read_shards(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files alone."""
    files = spark.read.schema(FILE_ROWS).parquet(path)
    # ids before each part: one number for each partition of the writing job
    sums = sorted(map(tuple, files.groupBy("part").agg(F.sum("ids")).collect()))
    offsets = np.zeros(sums[-1][0] + 1 if sums else 0, dtype=np.int64)
    before = 0
    for part, n in sums:
        offsets[part], before = before, before + n
    starts = spark.sparkContext.broadcast(offsets)

    def read(batches):
        for b in batches:
            for i in range(b.num_rows):
                shard = Shard.load(b.column(1)[i].as_py())
                ids = shard.matrix.decode().astype("<u4")
                raw, cuts = memoryview(ids.tobytes()), (shard.starts * 4).tolist()
                crc = np.fromiter((zlib.crc32(raw[a:z]) for a, z in zip(cuts, cuts[1:], strict=False)), dtype=np.int64, count=len(shard.docs))
                base = starts.value[b.column(0)[i].as_py()] + b.column(2)[i].as_py()
                yield pa.RecordBatch.from_arrays([pa.array(shard.docs), pa.array(shard.starts[:-1] + base), pa.array(np.diff(shard.starts)), pa.array(crc)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("part", "file", "base").mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_files(documents: DataFrame, tokenizer_file: str) -> DataFrame:
    path = shared_dir(documents.sparkSession) + "/shards"
    write_shards(documents, tokenizer_file, path)
    return read_shards(documents.sparkSession, path)
