"""Operator 10: approximate nearest neighbours by additive quantisation.

A vector (brought to length 1) is coded as a sum of full-dimensional codewords, one from each codebook; a beam search keeps the
best partial sums while it walks the residual codebooks. With each code goes the norm of its sum, so a query scores it from a
table of inner products: sum of lookups / stored norm. The best of each shard are ranked again by the exact cosine in double
precision, and the best of all shards remain. Codebooks are fitted on a bounded sample; every row is indexed.

Equal vectors are coded once, with as many of their smallest ids as a result can use, so thousands of copies cost no more than one.
The search is the stated query set against all rows, in blocks: its work is the number of queries times the number of rows.

Cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do those of another dimension
than the most frequent one (ties: the smaller); ids that are null take no part; a repeated id counts once, with the least of its
vectors (as arrays compare); ties go to the smaller vec_id; with fewer candidates than asked for, all are returned; other columns,
whatever their names, are not looked at; an empty table gives an empty result. Vectors are scaled by a power of two before their
squares are taken, so numbers of any size that a double holds, the smallest and the largest too, take part like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, partitions, shared_dir, shared_file, shared_files, written

#: Codebooks, words of each, beam width; rows the codebooks are fitted on at most; rounds of k-means.
BOOKS, WORDS, BEAM = 16, 256, 4
FIT_ROWS = 8192
FIT_ROUNDS = 8
#: Vectors of a shard at most, queries of a block, candidates of a shard that are ranked exactly.
SHARD = 4096
BLOCK = 512
SHORTLIST = 128
#: Bytes of the queries of a pass over the index (a task holds k results for each), and of a file of them.
GROUP_BYTES, QUERY_FILE = 256 << 20, 16 << 20
#: Stands where there is no id.
NONE = np.iinfo(np.int64).max


def _assign(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((words**2).sum(1) - 2 * x @ words.T).argmin(1)


def fit(x: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = FIT_ROUNDS, seed: int = 0) -> np.ndarray:
    """Residual codebooks (books, words, dims): k-means on what the books before leave over, then a joint refit by least squares."""
    draw = np.random.default_rng(seed)
    rest, out = x.copy(), []
    codes = np.empty((len(x), books), dtype=np.int64)
    for b in range(books):
        w = rest[draw.choice(len(rest), words, replace=len(rest) < words)].copy()
        for _ in range(rounds):
            a = _assign(rest, w)
            n = np.bincount(a, minlength=words)
            sums = np.zeros_like(w)
            np.add.at(sums, a, rest)
            w = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], w)
        codes[:, b] = _assign(rest, w)
        rest = rest - w[codes[:, b]]
        out.append(w)
    # all words of all books together, for the codes found
    wide = books * words
    flat = codes + np.arange(books) * words
    gram, right = np.zeros((wide, wide)), np.zeros((wide, x.shape[1]))
    for b in range(books):
        np.add.at(right, flat[:, b], x)
        for c in range(books):
            np.add.at(gram, (flat[:, b], flat[:, c]), 1.0)
    refit = np.linalg.solve(gram + 0.1 * np.eye(wide), right + 0.1 * np.concatenate(out))
    return refit.reshape(books, words, -1)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows, books) by beam search, and the norms of the sums."""
    n, (m, k, d) = len(x), books.shape
    codes = np.zeros((n, 1, 0), dtype=np.uint8)
    rest = x[:, None, :]
    for b in range(m):
        w = books[b]
        cost = (rest**2).sum(2)[:, :, None] - 2 * rest @ w.T + (w**2).sum(1)
        flat = cost.reshape(n, -1)
        keep = min(beam, flat.shape[1])
        best = np.argpartition(flat, keep - 1, axis=1)[:, :keep]
        from_, word = best // k, best % k
        row = np.arange(n)[:, None]
        codes = np.concatenate([codes[row, from_], word[:, :, None].astype(np.uint8)], axis=2)
        rest = rest[row, from_] - w[word]
    pick = (rest**2).sum(2).argmin(1)
    row = np.arange(n)
    return codes[row, pick], np.linalg.norm(x - rest[row, pick], axis=1)


def lookup_scores(queries: np.ndarray, codes: np.ndarray, norms: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Approximate cosines (queries, rows) from one table of inner products a query."""
    tables = np.einsum("qd,mkd->mkq", queries, books)
    total = np.zeros((len(codes), len(queries)))
    for b in range(books.shape[0]):
        total += tables[b][codes[:, b]]
    return (total / np.maximum(norms, 1e-12)[:, None]).T


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and v (double array) of the rows that take part, one for each id."""
    v = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    whole = v.filter("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    top = whole.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return whole.filter(F.size("v") == (top["d"] if top else 0)).groupBy("vec_id").agg(F.min("v").alias("v"))


def distinct_vectors(v: DataFrame, ids: int) -> DataFrame:
    """v and its smallest ids: ranks cut where the rows lie before any travels, so thousands of copies are a few rows."""
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    return v.withColumn("nth", nth).filter(F.col("nth") <= ids).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def _matrix(column: pa.Array) -> np.ndarray:
    return scaled(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) + 0.0)


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row times the power of two that brings its largest component between 1/2 and 1. Cosines stay what they are, to the last bit, and
    no square over- or underflows, however large or small the numbers are."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0, keepdims=True))[1])


def indexed(vectors: DataFrame, handle, ids: int, shard: int) -> DataFrame:
    """vectors(v, ids) -> a row for each shard: codes, norms, the vectors and their ids."""

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, shard):
                part = b.slice(lo, shard)
                raw, lists = _matrix(part.column(0)), part.column(1).to_pylist()
                codes, norms = encode((raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32), handle.value)
                names = np.full((len(lists), ids), NONE)
                for i, got in enumerate(lists):
                    names[i, : len(got)] = got
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (codes, norms.astype(np.float64), raw, names)], names=["codes", "norms", "raw", "ids"])

    return vectors.mapInArrow(run, "codes binary, norms binary, raw binary, ids binary")


def search_shard(q: np.ndarray, qids: np.ndarray, raw: np.ndarray, ids: np.ndarray, codes: np.ndarray, norms: np.ndarray, books: np.ndarray, k: int, shortlist: int) -> tuple[np.ndarray, np.ndarray]:
    """(queries, k) ids and exact cosines, best first, of the shard's shortlist by lookups; NONE and -inf where there are fewer."""
    qn, rn = np.linalg.norm(q, axis=1), np.linalg.norm(raw, axis=1)
    rough = lookup_scores(q / qn[:, None], codes, norms, books)
    keep = min(shortlist, len(raw))
    best = np.argpartition(-rough, keep - 1, axis=1)[:, :keep]
    exact = np.einsum("qd,qkd->qk", q, raw[best]) / (qn[:, None] * rn[best])
    # equal vectors bring their ids along
    them = ids[best].reshape(len(q), -1)
    score = np.repeat(exact, ids.shape[1], axis=1)
    score = np.where((them == qids[:, None]) | (them == NONE), -np.inf, score)
    return _best(np.where(np.isfinite(score), them, NONE), score, k)


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score), axis=1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)


def _asked(files: list[str], dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The queries of some files of the shared folder, a block at a time."""
    for f in files:
        with shared_file(f) as at:
            for b in pq.ParquetFile(at).iter_batches(batch_size=BLOCK, columns=["vec_id", "v"]):
                if b.num_rows:
                    yield b.column(0).to_numpy(), _matrix(b.column(1)).reshape(-1, dims)


def nearest(embeddings: DataFrame, k: int = 5, every: int = 50, shortlist: int = SHORTLIST, shard: int = SHARD, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by `every`.

    The queries are files in the shared folder, groups of about `group_bytes`; for each group there is one pass over the index. Its
    tasks read the group's files block by block beside their shards, so queries neither go through the driver nor lie in memory as a
    whole; a task keeps the best k of all shards that it reads. What is shuffled are k rows a query and task, and no vector travels for a comparison.
    """
    spark = embeddings.sparkSession
    bound_batches(spark)
    folder = shared_dir(spark)
    vectors = written(usable(embeddings), folder, "vectors")
    index = written(distinct_vectors(vectors, k + 1).withColumn("key", F.xxhash64("v")), folder, "distinct")
    rows = index.orderBy(F.xxhash64("key"), "v").select("v").limit(FIT_ROWS).toArrow()
    kind = "query_id bigint, vec_id bigint, score double"
    if not rows.num_rows:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    x = _matrix(rows.column(0).combine_chunks())
    dims = x.shape[1]
    books = spark.sparkContext.broadcast(fit(x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32))  # BOOKS * WORDS * dims numbers
    coded = written(indexed(index.select("v", "ids"), books, k + 1, shard), folder, "index")
    asked = vectors.filter(F.col("vec_id") % every == 0)
    n_asked = asked.count()
    turns = max(1, -(-n_asked * dims * 8 // group_bytes))
    at_once = max(1, min(partitions(spark), -(-n_asked * dims * 8 // QUERY_FILE)))
    dealt = asked.withColumn("turn", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(turns)))
    written(dealt.repartition(at_once, "vec_id"), folder, "queries", "turn")
    found = []
    for turn in range(turns if n_asked else 0):
        files = shared_files(spark, f"{folder}/queries/turn={turn}")
        if not files:
            continue

        def search(batches, files=files):
            best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for b in batches:
                shards = []
                for i in range(b.num_rows):
                    codes, norms, raw, names = (np.frombuffer(b.column(j)[i].as_py(), dtype=t) for j, t in enumerate((np.uint8, np.float64, np.float64, np.int64)))
                    raw = raw.reshape(-1, dims)
                    shards.append((raw, names.reshape(len(raw), -1), codes.reshape(len(raw), -1), norms))
                for n, (qids, q) in enumerate(_asked(files, dims)):
                    if n == len(best):
                        best.append((qids, np.full((len(q), k), NONE), np.full((len(q), k), -np.inf)))
                    _, ids, score = best[n]
                    for part in shards:
                        got = search_shard(q, qids, *part, books.value, k, shortlist)
                        ids[:], score[:] = _best(np.concatenate([ids, got[0]], axis=1), np.concatenate([score, got[1]], axis=1), k)
            for qids, ids, score in best:
                ok = ids != NONE
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qids, k)[ok.ravel()]), pa.array(ids[ok]), pa.array(score[ok])], names=["query_id", "vec_id", "score"])

        top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = coded.mapInArrow(search, kind).withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= k)
        found.append(written(ranked.select("query_id", "rank", "vec_id", "score"), folder, f"found{turn}"))
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out
