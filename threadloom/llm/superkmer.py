"""Operator 2: substring dedup by super-k-mer partitioning.

A window is K consecutive words of one document. Each window's minimiser is the least of its runs of SEED words, by hash, runs that
are frequent in the corpus last (so that a common phrase is no meeting place for all its surroundings); consecutive windows that share it travel together as one packed string of words (a super-k-mer) to the minimiser's bucket, so equal windows
meet in one bucket wherever they stand. There the words get exact numbers, the windows are sorted, and neighbours in the sorted
order are compared word by word. Equal super-k-mers of a slice of the input travel once, with the places they stand at, so a hot
passage or a group of copies costs one string a slice. What comes back to a document are runs of windows that also start in a
document with a smaller doc_id; the words they cover are taken out.

Cases: a null or empty text has no words; texts of fewer than K words lose none; a repeated row is judged like its twin (the
doc_id is not smaller, so neither loses words to the other); rows of one doc_id with different texts are told apart by a 32-bit
tag of the text; ties cannot arise, a window counts as seen if any smaller doc_id has it; a very long text is a slice of its own;
other columns, whatever their names, stay as they are; rows with a null doc_id are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    U64, Tally, binary_rows, bound_batches, byte_view, docs_of, groups, heavy, lean, member, mix, pack, partitions, ragged, slices,
    text_bytes, unpack, word_hashes, word_spans,
)

#: Words of a window and of a minimiser seed.
K, SEED = 13, 3
#: Input bytes for each bucket: packed strings are some three times the text they come from.
BUCKET_BYTES = 4 << 20
SLICE = 4 << 20
#: Bytes of text whose words are taken out, and digested, at a time.
STRIP = 1 << 20
#: A seed with this share of all words is frequent; so many of these at most.
SHARE, FREQUENT = 2e-5, 1 << 17
#: Set in the hashes of frequent seeds: they come after 65535 of 65536 others.
LAST = U64(0xFFFF << 48)
#: Compression of the packed strings: they are most of what is shuffled.
LEVEL = 6


def tagged(documents: DataFrame, *more: str) -> DataFrame:
    return docs_of(documents, *more).withColumn("tag", (F.xxhash64("text") % (1 << 31)).cast("int"))


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words with one blank behind each, and where each begins (and the end)."""
    lengths = ends - starts + 1
    at = np.r_[0, np.cumsum(lengths)]
    out = data[np.minimum(ragged(starts, lengths), len(data) - 1)] if len(data) else data
    out[at[1:] - 1] = 0x20
    return out, at


def seeds(h: np.ndarray, seed: int | None = None) -> np.ndarray:
    """A hash for each run of SEED words."""
    seed = seed or SEED
    g = h[: max(0, len(h) - seed + 1)].copy()
    for j in range(1, seed):
        g = mix(g * U64(0x9E3779B97F4A7C15) + h[j : len(h) - seed + 1 + j])
    return g


def minimisers(h: np.ndarray, k: int = K, seed: int | None = None, often: np.ndarray = np.zeros(0, dtype=U64)) -> np.ndarray:
    """For each window start the least seed of the window (windows that leave the array are cut off). The order is that of the
    hashes, frequent seeds last, so a seed that is everywhere is no meeting place unless a window holds no other."""
    seed = seed or SEED
    g = seeds(h, seed)
    g |= (member(g, often) >= 0).astype(U64) * LAST
    wide, least, span = k - seed + 1, g, 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = wide - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def super_kmers(batch_part: pa.RecordBatch, buckets: int, k: int = K, often: np.ndarray = np.zeros(0, dtype=U64)):
    """Packed blobs of a slice (doc_id, tag, text): one for each bucket that it has super-k-mers for."""
    data, offsets = byte_view(batch_part.column(2))
    starts, ends, first = word_spans(data, offsets)
    counts = np.diff(first)
    if not len(starts) or counts.max() < k:
        return
    h = word_hashes(data, starts, ends)
    least = minimisers(h, k, often=often)
    owner = np.repeat(np.arange(len(counts)), counts)
    windows = np.flatnonzero(np.arange(len(least)) + k <= first[owner[: len(least)] + 1])
    value, row = least[windows], owner[windows]
    fresh = np.r_[True, (value[1:] != value[:-1]) | (row[1:] != row[:-1])]
    heads = np.flatnonzero(fresh)
    runs, at_word = np.diff(np.r_[heads, len(windows)]), windows[heads]
    bucket = ((mix(value[heads]) >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    runs, at_word, bucket = runs[order], at_word[order], bucket[order]
    words, at = _joined(data, starts, ends)
    ids = batch_part.column(0).to_numpy()
    tags = batch_part.column(1).to_numpy()
    lo, hi = at[at_word], at[at_word + runs + k - 1]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for a, z in zip([0, *cuts], [*cuts, len(bucket)], strict=True):
        sizes = hi[a:z] - lo[a:z]
        text = words[ragged(lo[a:z], sizes)]
        strings = pa.Array.from_buffers(pa.large_binary(), z - a, [None, pa.py_buffer(np.r_[0, np.cumsum(sizes)].astype(np.int64).tobytes()), pa.py_buffer(text.tobytes())]).dictionary_encode()
        kinds, raw = _flat(strings.dictionary)
        rows = owner[at_word[a:z]]
        blob = pack(raw, kinds.astype(np.uint32), strings.indices.to_numpy().astype(np.uint32), np.diff(ids[rows], prepend=0), np.diff(tags[rows], prepend=0), (at_word[a:z] - first[rows]).astype(np.uint32), runs[a:z].astype(np.uint16 if runs.max() < 65536 else np.uint32), level=LEVEL)
        yield int(bucket[a]), blob


def _flat(column: pa.Array) -> tuple[np.ndarray, bytes]:
    """Lengths of the values, and the values end to end."""
    data, offsets = byte_view(column)
    return np.diff(offsets), data.tobytes()


def windows_seen_before(blobs: list[bytes], k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one bucket: doc_id, tag, start and number of the runs of windows that also start in a document with a smaller doc_id."""
    parts = [unpack(b) for b in blobs]
    raw = b"".join(p[0] for p in parts)
    lengths = np.concatenate([p[1] for p in parts]).astype(np.int64)
    base = np.cumsum([0] + [len(p[1]) for p in parts])
    kind = np.concatenate([p[2].astype(np.int64) + b for p, b in zip(parts, base, strict=False)])
    doc = np.concatenate([np.cumsum(p[3]) for p in parts])
    tag = np.concatenate([np.cumsum(p[4]) for p in parts])
    start = np.concatenate([p[5].astype(np.int64) for p in parts])
    runs = np.concatenate([p[6].astype(np.int64) for p in parts])
    del parts
    # the same string from several slices becomes one
    strings = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(np.r_[0, np.cumsum(lengths)].astype(np.int64).tobytes()), pa.py_buffer(raw)]).dictionary_encode()
    kind = strings.indices.to_numpy().astype(np.int64)[kind]
    lengths, raw = _flat(strings.dictionary)
    data = np.frombuffer(raw, dtype=np.uint8)
    stops = np.flatnonzero(data == 0x20) + 1  # each word ends with its blank
    words = pa.Array.from_buffers(pa.large_binary(), len(stops), [None, pa.py_buffer(np.r_[0, stops].astype(np.int64).tobytes()), pa.py_buffer(raw)]).dictionary_encode().indices.to_numpy()
    word_at = np.r_[0, np.searchsorted(stops, np.cumsum(lengths), side="right")]
    per = np.diff(word_at) - k + 1  # windows of each string
    places = ragged(word_at[:-1], per)
    of = np.repeat(np.arange(len(per)), per)
    least_doc = np.full(len(per), np.iinfo(np.int64).max)
    np.minimum.at(least_doc, kind, doc)
    # sort the windows by a hash of their words, then look at the words themselves
    codes = mix(words.astype(U64) + U64(1))
    key = np.zeros(len(places), dtype=U64)
    for j in range(k):
        key = key * U64(0x9E3779B97F4A7C15) + codes[places + j]
    order = np.argsort(key, kind="stable")
    sorted_key, sorted_places = key[order], places[order]
    same = np.zeros(len(order), dtype=bool)
    same[1:] = sorted_key[1:] == sorted_key[:-1]
    check = np.flatnonzero(same)
    equal = np.ones(len(check), dtype=bool)
    for j in range(k):
        equal &= words[sorted_places[check] + j] == words[sorted_places[check - 1] + j]
    if not equal.all():  # one hash for different windows: settle those by the words, in full order
        full = np.lexsort([words[places + j] for j in range(k - 1, -1, -1)])
        order, sorted_places = full, places[full]
        same[1:] = np.logical_and.reduce([words[sorted_places[1:] + j] == words[sorted_places[:-1] + j] for j in range(k)])
    heads = np.flatnonzero(~same)
    least = np.minimum.reduceat(least_doc[of[order]], heads) if len(heads) else np.zeros(0, dtype=np.int64)
    first_doc = np.empty(len(places), dtype=np.int64)
    first_doc[order] = np.repeat(least, np.diff(np.r_[heads, len(order)]))
    # each place a string stands at: its windows against the least doc_id; strings whose every window is first where they stand fall out early
    string_at = np.cumsum(per) - per
    lowest = np.minimum.reduceat(first_doc, string_at) if len(per) else first_doc
    hit = np.flatnonzero(lowest[kind] < doc)
    kind, doc, tag, start, runs = kind[hit], doc[hit], tag[hit], start[hit], runs[hit]
    spread = ragged(string_at[kind], runs)
    where = np.repeat(np.arange(len(kind)), runs)
    before = np.flatnonzero(first_doc[spread] < doc[where])
    where, pos = where[before], (np.arange(len(spread)) - np.repeat(np.cumsum(runs) - runs, runs))[before] + start[where[before]] if len(before) else before
    if not len(before):
        return (np.zeros(0, dtype=np.int64),) * 4
    fresh = np.r_[True, (where[1:] != where[:-1]) | (pos[1:] != pos[:-1] + 1)]
    head = np.flatnonzero(fresh)
    return doc[where[head]], tag[where[head]], pos[head], np.diff(np.r_[head, len(pos)])


def frequent_seeds(docs: DataFrame) -> np.ndarray:
    """Seeds that take a share of SHARE or more of all words, the FREQUENT most frequent ones at most, ascending. It only decides where windows meet, not which are equal."""

    def count(batches):
        lean()
        often = Tally(SHARE / 4)
        for whole in batches:
            for b in slices(whole, most=SLICE):
                data, offsets = byte_view(b.column(0))
                h = word_hashes(data, *word_spans(data, offsets)[:2])
                often.add(seeds(h), len(h))
        hashes, times = often.result()
        yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(times, pa.int64()), pa.array([often.rows] * len(hashes), pa.int64())], names=["hash", "n", "words"])

    found = docs.select("text").filter("text IS NOT NULL").mapInArrow(count, "hash bigint, n bigint, words bigint")
    # as many bytes a word as the texts have on average, six with the blank behind it
    return heavy(found.select("hash", "n"), text_bytes(docs) // 6, SHARE / 2, FREQUENT)[0]


def covered_runs(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, tag, runs: packed pairs (start, number) of the windows that a document with a smaller doc_id has too."""
    spark = docs.sparkSession
    bound_batches(spark)
    buckets = groups(text_bytes(docs), BUCKET_BYTES, 4 * partitions(spark))
    often = spark.sparkContext.broadcast(frequent_seeds(docs))  # FREQUENT hashes at most

    def cut(batches):
        lean()
        for whole in batches:
            for b in slices(whole, most=SLICE):
                got = list(super_kmers(b, buckets, k, often.value))
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in got], pa.int32()), pa.array([x for _, x in got], pa.binary())], names=["bucket", "blob"])

    def meet(key, t):
        lean()
        doc, tag, start, n = windows_seen_before(t.column("blob").to_pylist(), k)
        order = np.lexsort((start, tag, doc))
        doc, tag = doc[order], tag[order]
        pairs = np.stack([start[order], n[order]], axis=1).astype("<i4")
        heads = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]) if len(doc) else np.zeros(0, dtype=np.int64)
        return pa.table({"doc_id": pa.array(doc[heads]), "tag": pa.array(tag[heads].astype(np.int32)), "runs": binary_rows(np.r_[heads, len(doc)] * 8, pairs)})

    blobs = docs.select("doc_id", "tag", "text").filter("text IS NOT NULL").mapInArrow(cut, "bucket int, blob binary")
    found = blobs.groupBy("bucket").applyInArrow(meet, "doc_id bigint, tag int, runs binary")
    # a document's runs are at most as many as its words
    return found.groupBy("doc_id", "tag").agg(F.collect_list("runs").alias("runs"))


def kept_words(texts: pa.Array, runs: pa.Array, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For texts and their lists of packed runs: words and removed words of each text; the kept words of all texts joined by one blank, and where each text's begin."""
    data, offsets = byte_view(texts)
    starts, ends, first = word_spans(data, offsets)
    step = np.zeros(len(starts) + 1, dtype=np.int64)
    for row, lists in enumerate(runs.to_pylist()):
        if lists:
            pairs = np.frombuffer(b"".join(lists), dtype="<i4").reshape(-1, 2).astype(np.int64)
            np.add.at(step, first[row] + pairs[:, 0], 1)
            np.add.at(step, first[row] + pairs[:, 0] + pairs[:, 1] + k - 1, -1)
    keep = np.cumsum(step[:-1]) == 0
    words, at = _joined(data, starts[keep], ends[keep])
    bounds = np.r_[0, np.cumsum(keep)][first]
    return np.diff(first), np.diff(first) - np.diff(bounds), words, at[bounds]


def with_runs(documents: DataFrame, docs: DataFrame, k: int = K) -> DataFrame:
    return documents.join(covered_runs(docs, k), ["doc_id", "tag"], "left")


def substring_dedup(documents: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    docs = tagged(documents)

    def digest(batches):
        lean()
        for whole in batches:
            for b in slices(whole, most=STRIP):
                n, removed, words, at = kept_words(b.column(1), b.column(2), k)
                raw = memoryview(words.tobytes())
                sha = [hashlib.sha256(raw[a : z - 1] if z > a else b"").hexdigest() for a, z in zip(at.tolist(), at[1:].tolist(), strict=False)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(removed), pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return with_runs(docs, docs, k).select("doc_id", "text", "runs").mapInArrow(digest, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def without_repeats(documents: DataFrame, k: int = K) -> DataFrame:
    """The documents with repeated windows taken out of their texts: those that lose words have the kept ones joined by one blank,
    the others keep their text as it is; those that lose all their words go. n_chars follows the text; other columns stay."""
    spark = documents.sparkSession
    bound_batches(spark)
    docs = tagged(documents)
    # names of our own beside whatever columns the documents have
    found = covered_runs(docs, k).select(F.col("doc_id").alias("_superkmer_id"), F.col("tag").alias("_superkmer_tag"), F.col("runs").alias("_superkmer_runs"))
    tag = (F.xxhash64(documents["text"]) % (1 << 31)).cast("int")
    rest = [c for c in documents.columns if c != "text"]
    joined = documents.join(found, (documents["doc_id"] == found["_superkmer_id"]) & (tag == found["_superkmer_tag"]), "left").select(*rest, "text", "_superkmer_runs")

    def strip(batches):
        lean()
        for full in batches:
            for b in slices(full, most=STRIP):
                i, j = b.schema.get_field_index("text"), b.schema.get_field_index("_superkmer_runs")
                n, removed, words, at = kept_words(b.column(i), b.column(j), k)
                raw = words.tobytes()
                texts = [old if not gone else raw[a : z - 1].decode() for old, gone, a, z in zip(b.column(i).to_pylist(), removed.tolist(), at.tolist(), at[1:].tolist(), strict=False)]
                out = pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in rest), pa.array(texts, pa.string())], names=[*rest, "text"])
                yield out.filter(pa.array((removed == 0) | (removed < n)))

    kinds = dict(documents.dtypes)
    out = joined.mapInArrow(strip, ", ".join(f"`{c}` {kinds[c]}" for c in [*rest, "text"]))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.length("text").cast(kinds["n_chars"]))
    return out.select(*documents.columns)


#: For DuckDB.
SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
win AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
seen AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS f FROM win) WHERE f < doc_id),
cov AS (SELECT DISTINCT doc_id, i + k AS p FROM seen, range(13) t(k)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT w.doc_id, string_agg(x, ' ' ORDER BY w.p) AS t, count(*) AS n FROM word w ANTI JOIN cov c ON w.doc_id = c.doc_id AND w.p = c.p GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
