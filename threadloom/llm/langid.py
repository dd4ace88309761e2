"""Operator 1: language identification by multinomial naive Bayes over hashed character n-grams.

The log probabilities are a sparse matrix, buckets by languages: only what a bucket has beyond the smoothing is stored. It is
broadcast in blocks of languages of about CELLS cells, one pass over the documents for each (one in all, unless there are very many
languages), so any number of languages is scored in one and the same feature space. Texts are scored a slice at a time, as a sparse
matrix of their n-gram counts times the block's.

Cases: a null text or one without a letter is `und` with score 0; rows with a null lang are scored and not learned from, nor is a
language without text; without any learned language every text is `und`; a tie goes to the smaller language name by code point;
repeated rows are scored (and counted) each; a very long text is read in stretches, n-grams over the seams counted; rows with a null
doc_id are left out; other columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, crc_mod, docs_of, ragged, shared_dir, slices, written

#: N-gram orders; hash buckets; cells of a block of languages, about; smoothing.
ORDERS = (1, 2, 3)
DIMS = 1 << 15
CELLS = 1 << 21
ALPHA = 0.05
#: Bytes of the texts that are scored at a time, and cells of their scores at most.
SLICE, SCORES = 1 << 20, 1 << 22
#: Cells that a task counts before it sends them on.
HELD = 1 << 21
#: Characters of a text taken at a time; n-grams over the seam are kept.
STRETCH = 1 << 20


@lru_cache(1)
def _letters() -> np.ndarray:
    """The lower-case code of each letter of the first plane, 0 for anything else."""
    codes = np.zeros(65536, dtype=np.uint32)
    for c in range(65536):
        if (s := chr(c)).isalpha():
            codes[c] = ord(s.lower()[0])
    return codes


def grams(text: str, dims: int) -> Iterator[np.ndarray]:
    """Buckets of the character n-grams of a text, stretch by stretch. What is no letter counts as one gap, however long."""
    last = np.zeros(1, dtype=np.uint32)
    table, wide = _letters(), max(ORDERS)
    for lo in range(0, len(text), STRETCH):
        raw = np.frombuffer(text[lo : lo + STRETCH].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = np.where(raw < 65536, table[np.minimum(raw, 65535)], raw)
        codes = np.concatenate([last, codes])
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
        keep[: len(last) - 1] = True
        codes = codes[keep]
        fresh = len(last) - 1
        hashed = np.zeros(len(codes), dtype=np.uint32)
        for n in range(1, wide + 1):
            m = len(codes) - n + 1
            if m <= 0:
                break
            hashed = hashed[:m] * np.uint32(0x01000193) + codes[n - 1 :] + np.uint32(n)
            if n in ORDERS:
                new = hashed[max(0, fresh - n + 2) if lo else 0 :]
                mixed = (new ^ (new >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                yield ((mixed ^ (mixed >> np.uint32(13))) & np.uint32(dims - 1)).astype(np.int64)
        last = codes[-(wide - 1) :] if len(codes) >= wide - 1 else codes


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def profile(text: str, dims: int) -> np.ndarray:
    """N-gram counts of one text, bucket by bucket."""
    total = np.zeros(dims, dtype=np.int64)
    for x in grams(text, dims):
        total += np.bincount(x, minlength=dims)
    return total


def _counted(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, ascending, and how often each comes."""
    order = np.argsort(keys) if times is not None else None
    keys = np.sort(keys) if order is None else keys[order]
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    n = np.diff(np.r_[heads, len(keys)]) if order is None else np.add.reduceat(times[order], heads) if len(keys) else times
    return keys[heads], n


def profiles(texts: list[str | None], dims: int = DIMS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram counts of texts as a sparse matrix: rows, buckets, counts, in that order. The same as profile() of each."""
    texts = [t or "" for t in texts]
    long = [i for i, t in enumerate(texts) if len(t) > STRETCH]
    short = texts if not long else [t if len(t) <= STRETCH else "" for t in texts]
    lengths = np.fromiter(map(len, short), dtype=np.int64, count=len(short))
    raw = np.frombuffer("".join(short).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    # a gap before each text, then its letters; gaps in a row are one
    first = np.cumsum(lengths + 1) - lengths - 1
    codes = np.zeros(len(raw) + len(short), dtype=np.uint32)
    codes[ragged(first + 1, lengths)] = np.where(raw < 65536, _letters()[np.minimum(raw, 65535)], raw)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    keep[first] = lengths > 0
    codes, owner = codes[keep], np.repeat(np.arange(len(short)), lengths + 1)[keep]
    hashed, keys = np.zeros(len(codes), dtype=np.uint32), []
    for n in range(1, max(ORDERS) + 1):
        m = max(0, len(codes) - n + 1)
        hashed = hashed[:m] * np.uint32(0x01000193) + codes[n - 1 :] + np.uint32(n)
        if n in ORDERS:
            mixed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            whole = owner[:m] == owner[n - 1 :]
            keys.append((owner[:m] * dims + ((mixed ^ (mixed >> np.uint32(13))) & np.uint32(dims - 1)).astype(np.int64))[whole])
    key, count = _counted(np.concatenate(keys))
    if long:
        dense = [profile(texts[i], dims) for i in long]
        key = np.r_[key, np.concatenate([i * dims + np.flatnonzero(d) for i, d in zip(long, dense, strict=True)])]
        count = np.r_[count, np.concatenate([d[d > 0] for d in dense])]
        order = np.argsort(key)
        key, count = key[order], count[order]
    return key // dims, key % dims, count


def cells(train: DataFrame) -> DataFrame:
    """lang, bucket, n: n-gram counts of each language, learned from all of train(text, lang); added up where the texts lie first."""
    bound_batches(train.sparkSession)

    def count(batches):
        names: dict[str, int] = {}
        keys, times, held = [], [], 0

        def send():
            key, n = _counted(np.concatenate(keys), np.concatenate(times))
            lang = pa.DictionaryArray.from_arrays(pa.array(key // DIMS, pa.int32()), pa.array(list(names), pa.string())).cast(pa.string())
            return pa.RecordBatch.from_arrays([lang, pa.array(key % DIMS, pa.int32()), pa.array(n, pa.int64())], names=["lang", "bucket", "n"])

        for whole in batches:
            for b in slices(whole, most=SLICE):
                slot = np.array([names.setdefault(x, len(names)) for x in b.column(1).to_pylist()], dtype=np.int64)
                row, bucket, n = profiles(b.column(0).to_pylist())
                key, n = _counted(slot[row] * DIMS + bucket, n)
                keys.append(key)
                times.append(n)
                held += len(key)
                if held > HELD:
                    key, n = _counted(np.concatenate(keys), np.concatenate(times))
                    keys, times, held = [key], [n], len(key)
                    if held > HELD // 2:
                        yield send()
                        names, keys, times, held = {}, [], [], 0
        if held:
            yield send()

    some = train.filter("lang IS NOT NULL AND text IS NOT NULL AND text <> ''").select("text", "lang").mapInArrow(count, "lang string, bucket int, n bigint")
    return some.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Block:
    """Log probabilities of some languages, in code-point order: what is common to all buckets, and the rest by bucket."""

    def __init__(self, lang: list[str], bucket: np.ndarray, n: np.ndarray):
        self.langs = sorted(set(lang))
        at = {x: i for i, x in enumerate(self.langs)}
        of = np.fromiter((at[x] for x in lang), dtype=np.int64, count=len(lang))
        total = np.bincount(of, weights=n, minlength=len(self.langs)) + ALPHA * DIMS
        self.base = np.log(ALPHA) - np.log(total)
        order = np.argsort(bucket, kind="stable")
        self.first = np.searchsorted(bucket[order], np.arange(DIMS + 1))
        self.of, self.more = of[order], np.log(n[order] + ALPHA) - np.log(ALPHA)

    def joint(self, texts: list[str | None]) -> np.ndarray:
        """(texts, languages): log probability of all n-grams of each text."""
        row, bucket, n = profiles(texts)
        lengths = self.first[bucket + 1] - self.first[bucket]
        cell = ragged(self.first[bucket], lengths)
        where = np.repeat(row, lengths) * len(self.langs) + self.of[cell]
        out = np.bincount(where, weights=np.repeat(n, lengths) * self.more[cell], minlength=len(texts) * len(self.langs)).reshape(len(texts), -1)
        return out + np.bincount(row, weights=n, minlength=len(texts))[:, None] * self.base


def fit(train: DataFrame) -> list:
    """Broadcast blocks of languages that have all of train(text, lang) for their counts."""
    spark = train.sparkSession
    found = written(cells(train), shared_dir(spark), "cells")
    blocks = -(-found.count() // CELLS)
    out = []
    for k in range(blocks):
        got = found.filter(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == k).toArrow()  # about CELLS rows
        if got.num_rows:
            out.append(spark.sparkContext.broadcast(Block(got.column("lang").to_pylist(), got.column("bucket").to_numpy(), got.column("n").to_numpy())))
    return out


def predict(docs: DataFrame, blocks: list) -> DataFrame:
    """docs(text, ...) -> lang_pred, score instead of the text; the other columns of docs stay. Priors are flat: n-grams alone decide."""
    bound_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c != "text"]
    kinds = dict(docs.dtypes)
    state = docs.select(*rest, "text", F.lit(None).cast("string").alias("lang_pred"), F.lit(None).cast("double").alias("_best"), F.lit(0.0).alias("_sum"))

    def scorer(handle):
        def score(batches):
            block = handle.value
            rows = max(1, SCORES // len(block.langs))
            for whole in batches:
                for some in slices(whole, most=SLICE):
                    for b in (some.slice(lo, rows) for lo in range(0, some.num_rows, rows)):
                        texts, name, best, total = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("text", "lang_pred", "_best", "_sum"))
                        joint = block.joint(texts)
                        top = joint.argmax(1)
                        high = joint[np.arange(len(texts)), top]
                        sums = np.exp(joint - high[:, None]).sum(1)
                        for i, text in enumerate(texts):
                            if not has_letter(text):
                                continue
                            new, s, lang = float(high[i]), float(sums[i]), block.langs[top[i]]
                            if best[i] is not None:
                                old = best[i]
                                total[i], keep = total[i] * np.exp(min(0.0, old - new)) + s * np.exp(min(0.0, new - old)), (old, name[i])
                                best[i], name[i] = keep if (-old, name[i]) < (-new, lang) else (new, lang)
                            else:
                                best[i], total[i], name[i] = new, s, lang
                        yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in [*rest, "text"]), pa.array(name, pa.string()), pa.array(best, pa.float64()), pa.array(total, pa.float64())], names=[*rest, "text", "lang_pred", "_best", "_sum"])

        return score

    for handle in blocks:
        state = state.mapInArrow(scorer(handle), ", ".join(f"`{c}` {kinds[c]}" for c in rest) + ", text string, lang_pred string, _best double, _sum double")
    return state.select(*rest, F.coalesce("lang_pred", F.lit("und")).alias("lang_pred"), F.when(F.col("_sum") > 0, 1 / F.col("_sum")).otherwise(0.0).alias("score"))


def language_id(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    docs = docs_of(documents, "lang").withColumn("held_out", crc_mod("doc_id", 4) == 2)
    blocks = fit(docs.filter("NOT held_out").select("text", "lang"))
    return predict(docs.select("doc_id", "held_out", "text"), blocks)
