"""Operator 3: language-model scoring by prediction by partial matching (PPM) over bytes, beside a word-count base line.

The model is a trie of byte contexts up to ORDER, pretrained on the training texts: counts of all (ORDER + 1)-grams of the
lower-cased bytes are gathered (a start mark pads a text, an end mark closes it), and shorter contexts are their sums. A symbol is
coded in the longest known context; a symbol that is new there costs an escape (method D: each new symbol had taken half its count from it)
and goes on to the next shorter context, in which the symbols of the longer one are excluded; below order 0 all symbols left are
equally likely. A text's score is the log10 probability of its bytes and its end mark.

Every training text is counted, and every context is kept: the trie lies in buckets by the last two symbols of the context, which
hold all longer contexts that escape into each other; only orders 0 and 1 (65536 pairs and some) are sent to all. Each bucket works
out the cost of every distinct gram of the corpus. The CACHED most used costs are broadcast, which only saves traffic: all others
meet the documents that ask for them in slots by hash, whose sums go on to blocks of documents.

The base line needs each word's count in the training texts. Slices send each bucket of the word space their distinct words, once
however many documents have them, and the bucket's counts meet the slice's documents in its block, so no vocabulary is gathered.

Cases: a null or empty text is its end mark alone; no training text: counts are 0 and every symbol equally likely; repeated rows
are counted and scored each (rows of one doc_id and one text share their sums evenly); no ties arise, sums don't depend on order; a
very long text is a slice of its own, its sums meet in its block; other columns, whatever their names, are not looked at; rows with
a null doc_id are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    LOWER, U64, bound_batches, byte_view, crc_mod, docs_of, groups, lean, mix, pack, partitions, ragged, shared_dir, slices,
    text_bytes, unpack, word_hashes, word_spans, written,
)

ORDER = 5
#: Text bytes for each bucket of grams or words, slot of costs and block of documents.
BUCKET_BYTES = 8 << 20
#: Costs that are broadcast; the others are looked up in their slots.
CACHED = 1 << 20
#: Symbols: bytes, the end mark, the start mark (context only); bits of a symbol in a key.
END, START, BITS, SYMBOLS = 256, 257, 9, 257
GRAM_SLICE, WORD_SLICE = 2 << 20, 4 << 20
#: Distinct grams a task holds before it sends them on.
HELD = 4_000_000


def _mask(symbols: int) -> int:
    return (1 << BITS * symbols) - 1


def gram_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A key of ORDER + 1 symbols for every byte and end mark, and where each text's begin."""
    data, offsets = byte_view(texts)
    lengths = np.diff(offsets)
    at = np.r_[0, np.cumsum(lengths + ORDER + 1)]
    sym = np.full(int(at[-1]), START, dtype=np.int64)
    sym[ragged(at[:-1] + ORDER, lengths)] = LOWER[data]
    sym[at[1:] - 1] = END
    key = sym.copy()
    for j in range(1, ORDER + 1):
        key[j:] += sym[:-j] << BITS * j
    keep = np.ones(len(sym), dtype=bool)
    keep[ragged(at[:-1], np.full(len(lengths), ORDER))] = False
    return key[keep], np.r_[0, np.cumsum(lengths + 1)]


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    heads = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, dtype=np.int64)
    return k[heads], np.add.reduceat(c, heads) if len(k) else c


def gram_blobs(texts: DataFrame, size: int) -> DataFrame:
    """texts(learn, text) -> bucket, blob: distinct grams, each shifted by one bit that says whether the texts teach, and their counts."""
    spark = texts.sparkSession
    bound_batches(spark)
    buckets = groups(size, BUCKET_BYTES, 2 * partitions(spark))

    def send(keys, counts):
        k, c = _merged(keys, counts)
        bucket = ((mix((k >> BITS + 1 & _mask(2)).astype(U64)) >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        k, c, bucket = k[order], c[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        blobs = [(int(bucket[a]), pack(np.diff(k[a:z], prepend=0), c[a:z].astype(np.uint32))) for a, z in zip([0, *cuts], [*cuts, len(k)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in blobs], pa.int32()), pa.array([x for _, x in blobs], pa.binary())], names=["bucket", "blob"])

    def count(batches):
        lean()
        keys, counts, held = [], [], 0
        for whole in batches:
            for b in slices(whole, most=GRAM_SLICE):
                k, at = gram_keys(b.column(1))
                learn = np.asarray(b.column(0).to_pylist(), dtype=np.int64)
                k, c = np.unique(k << 1 | np.repeat(learn, np.diff(at)), return_counts=True)
                keys.append(k)
                counts.append(c)
                held += len(k)
                if held > HELD:
                    k, c = _merged(keys, counts)
                    if len(k) > HELD // 2:
                        yield send([k], [c])
                        keys, counts, held = [], [], 0
                    else:
                        keys, counts, held = [k], [c], len(k)
        if held:
            yield send(keys, counts)

    return texts.select("learn", "text").mapInArrow(count, "bucket int, blob binary")


def _met(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's distinct grams, ascending, their counts in texts that teach, and in all."""
    parts = [unpack(x) for x in t.column("blob").to_pylist()]
    k, c = _merged([np.cumsum(p[0]) for p in parts], [p[1].astype(np.int64) for p in parts])
    heads = np.flatnonzero(np.r_[True, np.diff(k >> 1) > 0])
    return k[heads] >> 1, np.add.reduceat(c * (k & 1), heads), np.add.reduceat(c, heads)


def pair_counts(train: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Keys and counts of orders 0 and 1; their number is bounded by the symbols'."""
    bound_batches(train.sparkSession)

    def count(batches):
        lean()
        n = np.zeros(1 << 2 * BITS, dtype=np.int64)
        for whole in batches:
            for b in slices(whole, most=GRAM_SLICE):
                n += np.bincount(gram_keys(b.column(0))[0] & _mask(2), minlength=len(n))
        k = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n[k])], names=["key", "n"])

    got = train.select("text").mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    k, c = _merged([got.column("key").to_numpy()], [got.column("n").to_numpy()])
    return [_merged([k & _mask(1)], [c]), (k, c)]


def gram_costs(docs: DataFrame, size: int) -> DataFrame:
    """docs(held_out, text) -> key, uses, cost: every distinct gram of all texts, how often it occurs, and its log10 probability under the trie of all training texts."""
    low = pair_counts(docs.filter("NOT held_out AND text IS NOT NULL"))
    handle = docs.sparkSession.sparkContext.broadcast(low)

    def meet(key, t):
        lean()
        keys, n, uses = _met(t)
        k, c = keys[n > 0], n[n > 0]
        levels = [(k, c)]
        for level in range(ORDER - 1, 1, -1):
            k, c = _merged([k & _mask(level + 1)], [c])
            levels.append((k, c))
        model = Model([*handle.value, *levels[::-1]])
        cost = np.concatenate([model.cost(keys[i : i + GRAM_SLICE]) for i in range(0, len(keys), GRAM_SLICE)])
        return pa.table({"key": keys, "uses": uses, "cost": cost})

    return gram_blobs(docs.select((~F.col("held_out") & F.col("text").isNotNull()).alias("learn"), "text"), size).groupBy("bucket").applyInArrow(meet, "key bigint, uses bigint, cost double")


def most(table: DataFrame, column: str, room: int) -> tuple:
    """The step of `column`, and the least step from which on at most `room` rows lie (None: not one step fits). Steps are powers of 2**(1/4), so the table of them is short."""
    step = F.floor(F.log2(column) * 4)
    least = None
    for at, n in sorted(map(tuple, table.groupBy(step.alias("step")).agg(F.count("*")).collect()), reverse=True):
        if n > room:
            break
        room, least = room - n, at
    return step, least


class Lookup:
    """Open addressing over 64-bit keys, filled and asked many keys at a time; a quarter full."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.slots = np.full(1 << self.bits, -1, dtype=np.int64)
        self.at = np.full(1 << self.bits, -1, dtype=np.int32)
        where, left = self._first(keys), np.arange(len(keys))
        while len(left):
            free = self.slots[where] < 0
            slot, one = np.unique(np.where(free, where, -1), return_index=True)
            slot, one = (slot[1:], one[1:]) if len(slot) and slot[0] < 0 else (slot, one)
            self.slots[slot], self.at[slot] = keys[left[one]], left[one]
            rest = np.ones(len(left), dtype=bool)
            rest[one] = False
            left, where = left[rest], (where[rest] + 1) & ((1 << self.bits) - 1)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(U64) * U64(0x9E3779B97F4A7C15) >> U64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, or -1."""
        where = self._first(keys)
        found = self.slots[where]
        out = np.where(found == keys, self.at[where], -1)
        left = np.flatnonzero((found != keys) & (found >= 0))
        where = where[left]
        while len(left):
            where = (where + 1) & ((1 << self.bits) - 1)
            found = self.slots[where]
            hit = found == keys[left]
            out[left[hit]] = self.at[where[hit]]
            go = ~hit & (found >= 0)
            left, where = left[go], where[go]
        return out


class Model:
    """Code lengths from a trie: everything that a symbol costs in its context, worked out in advance."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]):
        levels = [*levels, *[(np.zeros(0, dtype=np.int64),) * 2] * (ORDER + 1 - len(levels))]
        self.entries, self.contexts = [], []
        self.log_n, self.start, self.escape, self.after, self.after_escape, self.suffix, self.direct = [], [], [], [], [], [], []
        below = None
        for level, (keys, n) in enumerate(levels):
            context = keys >> BITS
            heads = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
            d = np.diff(np.r_[heads, len(keys)])
            total = np.add.reduceat(n, heads) if len(keys) else n
            names = context[heads]
            self.entries.append(Lookup(keys))
            self.contexts.append(Lookup(names))
            log = np.log10(np.maximum(2 * n - 1, 1))
            self.log_n.append(log)
            self.start.append(np.log10(np.maximum(2 * total, 1)))
            self.escape.append(np.log10(np.maximum(d, 1)) - self.start[-1])
            self.direct.append(log - np.repeat(self.start[-1], d))
            if level == 0:
                self.suffix.append(np.zeros(len(names), dtype=np.int64))
                self.after.append(np.zeros(len(names)))
                self.after_escape.append(np.zeros(len(names)))
            else:
                # in the shorter context, what the longer one has is excluded
                suffix = self.contexts[level - 1].find(names & _mask(level - 1)).astype(np.int64)
                theirs = below["n"][self.entries[level - 1].find(keys & _mask(level))] if len(keys) else n
                gone = np.add.reduceat(theirs, heads) if len(keys) else n
                new = below["d"][suffix] - d
                rest = 2 * (below["total"][suffix] - gone)
                self.suffix.append(suffix)
                self.after.append(np.log10(np.maximum(rest, 1)))
                self.after_escape.append(np.where(new > 0, np.log10(np.maximum(new, 1)) - self.after[-1], 0.0))
            below = {"n": n, "d": d, "total": total}
        distinct = len(levels[0][0])
        self.floor = -np.log10(max(1, SYMBOLS - distinct))

    def cost(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each key's symbol after its context."""
        out = np.zeros(len(keys))
        hit = self.entries[ORDER].find(keys)
        found = hit >= 0
        out[found] = self.direct[ORDER][hit[found]]
        left = np.flatnonzero(~found)
        keys = keys[left]
        came = self.contexts[ORDER].find(keys >> BITS) if len(left) else left  # context just escaped from, or -1
        total = np.where(came >= 0, self.escape[ORDER][came], 0.0) if len(self.escape[ORDER]) else np.zeros(len(left))
        for level in range(ORDER - 1, -1, -1):
            if not len(left):
                return out
            hit = self.entries[level].find(keys & _mask(level + 1))
            fresh = came < 0
            here = np.where(fresh, self.contexts[level].find(keys >> BITS & _mask(level)), -1)
            if len(self.suffix[level + 1]):
                here = np.where(fresh, here, self.suffix[level + 1][came])
            known = here >= 0
            if len(self.start[level]):
                first, first_escape = self.start[level][here], self.escape[level][here]
            else:
                first = first_escape = np.zeros(len(left))
            later, later_escape = (self.after[level + 1][came], self.after_escape[level + 1][came]) if len(self.after[level + 1]) else (first, first_escape)
            symbol = hit >= 0
            n = self.log_n[level][hit] if len(self.log_n[level]) else np.zeros(len(left))
            total = total + np.where(symbol, n - np.where(fresh, first, later), np.where(known, np.where(fresh, first_escape, later_escape), 0.0))
            out[left[symbol]] = total[symbol]
            go = ~symbol
            left, keys, total, came = left[go], keys[go], total[go], here[go]
        out[left] = total + self.floor
        return out


@lru_cache(1)
def _cached(handle) -> tuple[Lookup, np.ndarray]:
    keys, costs = handle.value
    return Lookup(keys), np.r_[costs, 0.0]


def _slot_of(hashes: np.ndarray, slots: int) -> np.ndarray:
    return ((hashes >> U64(32)) * U64(slots) >> U64(32)).astype(np.int64)


def _slot(keys: np.ndarray, slots: int) -> np.ndarray:
    return _slot_of(mix(keys.astype(U64)), slots)


def _block(name: bytes, blocks: int) -> int:
    return int.from_bytes(name, "little") * blocks >> 64


def _rows(names: list, blobs: list, columns: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], names=columns)


def _by_block(blocks: int, doc: np.ndarray, *columns: np.ndarray) -> tuple[list, list]:
    """Columns of documents, packed for each block of documents."""
    block = _slot(doc, blocks)
    order = np.argsort(block, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(block[order])) + 1) if len(doc) else []
    return [int(block[p[0]]) for p in parts], [pack(doc[p], *(c[p] for c in columns)) for p in parts]


def scores(docs: DataFrame, folder: str, size: int, room: int = CACHED) -> DataFrame:
    """docs(doc_id, tag, held_out, text) -> doc_id, tag, n_words, score; rows of one doc_id and tag share their sums evenly."""
    spark = docs.sparkSession
    bound_batches(spark)
    slots = blocks = groups(size, BUCKET_BYTES, partitions(spark))
    costs = written(gram_costs(docs, size), folder, "costs")
    step, least = most(costs, "uses", room)
    hot = costs.filter(step >= least).select("key", "cost").toArrow() if least is not None else None
    handle = spark.sparkContext.broadcast((hot.column("key").to_numpy(), hot.column("cost").to_numpy()) if hot is not None else (np.zeros(0, dtype=np.int64), np.zeros(0)))

    def deal(batches):
        """Costs that are not broadcast, to their slots."""
        lean()

        def send(held):
            keys, cost = (np.concatenate([h[i] for h in held]) for i in range(2))
            slot = _slot(keys, slots)
            order = np.lexsort((keys, slot))
            parts = np.split(order, np.flatnonzero(np.diff(slot[order])) + 1)
            return _rows([int(slot[p[0]]) for p in parts], [pack(0, np.diff(keys[p], prepend=0), cost[p]) for p in parts], ("slot", "blob"))

        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
                n += b.num_rows
            if n > HELD // 2:
                yield send(held)
                held, n = [], 0
        if held:
            yield send(held)

    def ask(batches):
        """Sums of what is broadcast, to the documents' blocks (numbered -1, -2, ...); all other grams to their slots."""
        lean()
        cache, cost = _cached(handle)
        done = []
        for whole in batches:
            for b in slices(whole, most=WORD_SLICE):
                ids, tags = b.column(0).to_numpy(), b.column(1).to_numpy()
                keys, at = gram_keys(b.column(2))
                hit = cache.find(keys)
                data, offsets = byte_view(b.column(2))
                done.append((ids, tags, np.add.reduceat(cost[hit], at[:-1]), np.diff(word_spans(data, offsets)[2]), np.ones(len(ids), dtype=np.int64)))
                rest = np.flatnonzero(hit < 0)
                row = np.repeat(np.arange(len(ids)), np.diff(at))[rest]
                keys = keys[rest]
                order = np.argsort(keys)
                keys, row = keys[order], row[order]
                slot = _slot(keys, slots).astype(np.uint16 if slots <= 65536 else np.int64)
                order = np.argsort(slot, kind="stable")
                names, blobs = [], []
                for p in np.split(order, np.flatnonzero(np.diff(slot[order].astype(np.int64))) + 1) if len(order) else []:
                    own, which = np.unique(row[p], return_inverse=True)
                    names.append(int(slot[p[0]]))
                    blobs.append(pack(1, np.diff(keys[p], prepend=0), which.astype(np.uint16 if len(own) <= 65536 else np.uint32), np.diff(ids[own], prepend=0), tags[own]))
                yield _rows(names, blobs, ("slot", "blob"))
                if len(done) > 64:
                    names, blobs = _by_block(blocks, *(np.concatenate([d[i] for d in done]) for i in range(5)))
                    yield _rows([-1 - x for x in names], blobs, ("slot", "blob"))
                    done = []
        if done:
            names, blobs = _by_block(blocks, *(np.concatenate([d[i] for d in done]) for i in range(5)))
            yield _rows([-1 - x for x in names], blobs, ("slot", "blob"))

    def meet(key, t):
        lean()
        slot = key[0].as_py()
        if slot < 0:
            return pa.table({"block": pa.array([-1 - slot] * t.num_rows, pa.int32()), "sums": t.column("blob")})
        parts = [unpack(x) for x in t.column("blob").to_pylist()]
        keys = np.concatenate([np.cumsum(p[1]) for p in parts if p[0] == 0])
        order = np.argsort(keys)
        keys, cost = keys[order], np.concatenate([p[2] for p in parts if p[0] == 0])[order]
        out = []
        for p in parts:
            if p[0]:
                found = cost[np.searchsorted(keys, np.cumsum(p[1]))]
                out.append((np.cumsum(p[3]), p[4], np.bincount(p[2], weights=found, minlength=len(p[3]))))
        if not out:
            return pa.table({"block": pa.array([], pa.int32()), "sums": pa.array([], pa.binary())})
        doc, tag, sums = (np.concatenate([x[i] for x in out]) for i in range(3))
        none = np.zeros(len(doc), dtype=np.int64)
        names, packed = _by_block(blocks, doc, tag, sums, none, none)
        return pa.table({"block": pa.array(names, pa.int32()), "sums": pa.array(packed, pa.binary())})

    def add(key, t):
        lean()
        parts = [unpack(x) for x in t.column("sums").to_pylist()]
        doc, tag, *sums = (np.concatenate([p[i] for p in parts]) for i in range(5))
        order = np.lexsort((tag, doc))
        doc, tag = doc[order], tag[order]
        heads = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])])
        score, n_words, times = (np.add.reduceat(x[order], heads) for x in sums)
        return pa.table({"doc_id": doc[heads], "tag": pa.array(tag[heads], pa.int32()), "n_words": n_words // times, "score": score / times, "times": times})

    rare = costs if least is None else costs.filter(step < least)
    asked = rare.select("key", "cost").mapInArrow(deal, "slot int, blob binary").unionByName(docs.select("doc_id", "tag", "text").mapInArrow(ask, "slot int, blob binary"))
    found = asked.groupBy("slot").applyInArrow(meet, "block int, sums binary").groupBy("block").applyInArrow(add, "doc_id bigint, tag int, n_words bigint, score double, times bigint")
    return found.select("doc_id", "tag", "n_words", "score", F.explode(F.sequence(F.lit(1).cast("bigint"), "times"))).drop("col")


#: Groups that the buckets' own sums are added up in, before they meet.
FAN = 1024


def word_sums(docs: DataFrame, size: int) -> DataFrame:
    """docs(doc_id, tag, held_out, text) -> doc_id, tag, logs (sum of log10(count + 0.5)), known, one row for each text; rows without a doc_id have, in FAN parts, the distinct words in known and the training words in logs.

    A slice sends each bucket of the word space its distinct words there, and its block which document has which of them. The bucket
    answers with the words' counts, in the order they came in, so what travels back follows the slice's words, not its documents.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    buckets = blocks = groups(size, BUCKET_BYTES, partitions(spark))

    def cut(batches):
        lean()
        for whole in batches:
            for b in slices(whole, most=WORD_SLICE):
                data, offsets = byte_view(b.column(3))
                starts, ends, first = word_spans(data, offsets)
                if not len(starts):
                    continue
                data = LOWER[data]
                sizes = ends - starts
                raw = data[ragged(starts, sizes)]
                words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.r_[0, np.cumsum(sizes)].astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())]).dictionary_encode()
                which = words.indices.to_numpy().astype(np.int64)
                text, cuts = byte_view(words.dictionary)
                bucket = _slot_of(word_hashes(text, cuts[:-1], cuts[1:]), buckets)
                rank = np.argsort(bucket, kind="stable")  # distinct words, bucket by bucket
                number = np.empty(len(rank), dtype=np.int64)
                number[rank] = np.arange(len(rank))
                owner = np.repeat(np.arange(b.num_rows), np.diff(first))
                learn = ~np.asarray(b.column(2).to_pylist(), dtype=bool)
                train = np.bincount(number[which], weights=learn[owner], minlength=len(rank)).astype(np.int64)
                pairs, times = np.unique(owner * len(rank) + number[which], return_counts=True)
                ids, tags = b.column(0).to_numpy(), b.column(1).to_numpy()
                # a slice is known by its documents
                name = hashlib.blake2b(np.stack([ids, tags.astype(np.int64)]).tobytes(), digest_size=8).digest()
                have, lows = np.unique(bucket[rank], return_index=True)  # only buckets that the slice has words for
                lengths = np.diff(cuts)[rank]
                names = [-1 - _block(name, blocks)]
                blobs = [pack(name, np.diff(ids, prepend=0), tags, np.bincount(pairs // len(rank), minlength=b.num_rows).astype(np.uint32), np.diff(pairs % len(rank), prepend=0).astype(np.int32), times.astype(np.uint32), have.astype(np.int32))]
                for k, lo, hi in zip(have.tolist(), lows.tolist(), [*lows[1:].tolist(), len(rank)], strict=True):
                    names.append(k)
                    blobs.append(pack(name, text[ragged(cuts[:-1][rank[lo:hi]], lengths[lo:hi])].tobytes(), lengths[lo:hi].astype(np.uint32), train[lo:hi].astype(np.uint32)))
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    def meet(key, t):
        lean()
        bucket = key[0].as_py()
        if bucket < 0:
            return pa.table({"block": pa.array([-1 - bucket] * t.num_rows, pa.int32()), "blob": t.column("blob")})
        parts = [unpack(x) for x in t.column("blob").to_pylist()]
        raw = b"".join(p[1] for p in parts)
        lengths = np.concatenate([p[2] for p in parts]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(np.r_[0, np.cumsum(lengths)].astype(np.int64).tobytes()), pa.py_buffer(raw)]).dictionary_encode()
        number = words.indices.to_numpy().astype(np.int64)
        count = np.bincount(number, weights=np.concatenate([p[3] for p in parts]), minlength=len(words.dictionary)).astype(np.int64)
        at = np.cumsum([0] + [len(p[2]) for p in parts])
        out = [(-1 - bucket % FAN, pack(int((count > 0).sum()), int(count.sum())))]
        out += [(_block(p[0], blocks), pack(p[0], bucket, count[number[lo:hi]])) for p, lo, hi in zip(parts, at, at[1:], strict=False)]
        return pa.table({"block": pa.array([x for x, _ in out], pa.int32()), "blob": pa.array([x for _, x in out], pa.binary())})

    def add(key, t):
        lean()
        parts = [unpack(x) for x in t.column("blob").to_pylist()]
        if key[0].as_py() < 0:
            return pa.table({"doc_id": pa.array([None], pa.int64()), "tag": pa.array([key[0].as_py()], pa.int32()), "logs": [float(sum(p[1] for p in parts))], "known": [sum(p[0] for p in parts)]})
        counts = {(p[0], p[1]): p[2] for p in parts if len(p) == 3}  # slices of the same documents get the same answer
        rows = []
        for name, ids, tags, n, word, times, have in (p for p in parts if len(p) > 3):
            count = np.concatenate([counts[name, k] for k in have.tolist()])[np.cumsum(word)]
            row = np.repeat(np.arange(len(ids)), n.astype(np.int64))
            rows.append((np.cumsum(ids), tags, *(np.bincount(row, weights=w * times, minlength=len(ids)) for w in (np.log10(count + 0.5), count > 0))))
        doc, tag, logs, known = (np.concatenate([r[i] for r in rows]) for i in range(4))
        return pa.table({"doc_id": doc, "tag": pa.array(tag, pa.int32()), "logs": logs, "known": known.astype(np.int64)})

    blobs = docs.select("doc_id", "tag", "held_out", "text").filter("text IS NOT NULL").mapInArrow(cut, "bucket int, blob binary")
    found = blobs.groupBy("bucket").applyInArrow(meet, "block int, blob binary").groupBy("block").applyInArrow(add, "doc_id bigint, tag int, logs double, known bigint")
    return found.groupBy("doc_id", "tag").agg(F.max("logs").alias("logs"), F.max("known").alias("known"))


def lm_scores(documents: DataFrame, room: int = CACHED) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    folder = shared_dir(documents.sparkSession)
    docs = docs_of(documents).withColumn("tag", (F.xxhash64("text") % (1 << 31)).cast("int")).withColumn("held_out", crc_mod("doc_id", 5) == 1)
    train = docs.filter("NOT held_out")
    size = text_bytes(docs)
    sums = written(word_sums(docs, size), folder, "words")
    ends = train.count()
    row = sums.filter("doc_id IS NULL").agg(F.sum("known").alias("known"), F.sum("logs").alias("logs")).first()
    distinct, total = row["known"] or 0, int(row["logs"] or 0)
    distinct, total = distinct + (ends > 0), total + ends
    scored = scores(docs, folder, size, room).join(sums.filter("doc_id IS NOT NULL"), ["doc_id", "tag"], "left")
    logs = F.coalesce("logs", F.lit(0.0)) + F.lit(float(np.log10(ends + 0.5)))
    per = float(np.log10(total + 0.5 * (distinct + 1)))
    tokens = F.col("n_words") + 1
    return scored.select(
        "doc_id",
        (crc_mod("doc_id", 5) == 1).alias("held_out"),
        tokens.cast("long").alias("n_tokens"),
        (F.coalesce("known", F.lit(0)) + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (logs - tokens * F.lit(per)).alias("base_score"),
        "score",
    )
