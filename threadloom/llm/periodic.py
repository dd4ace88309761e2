"""Operator 11: periodic runs of words, by the longest-previous-factor way to all maximal repetitions.

Words of a text are numbered; suffix array and LCP array give the longest previous factor (LPF) of each word, this the text's LZ
blocks. Every run either meets a block's edge or lies inside a block, where it is a copy of an earlier run. The first kind comes
from Main's extensions to both sides of each edge, the second from runs kept in buckets by their start, copied block by block
from left to right. (Main 1989; Kolpakov and Kucherov 1999; Crochemore, Ilie and Smyth 2008.)

Of the runs, those of at least `exponent` periods (2 or more) and `length` words are wanted. Let a run of period p cross the edge at
the start of block i as its last one: its part before the edge is shorter than p + l[i-1] (else block i-1, copied from p words before,
would reach over the edge), the part behind it at most l[i] long. So exponent * p < p + l[i-1] + l[i] bounds the periods tried at an
edge, and exponent and length don't change by copying: leaving out the others at once loses nothing.

The texts of a slice lie end to end. Suffixes are sorted by (document, words), so no comparison leaves a document; sorting doubles the
compared length and goes on with undecided suffixes only. Work grows as n log n at worst, memory as n times log of the longest repeat.

Cases: null and empty texts have no words and no runs; a very long text is a slice of its own, read whole; runs with equal length
are ordered by start, then period; repeated rows give repeated result rows; rows with a null doc_id are left out; other columns,
whatever their names, are ignored; an empty table gives an empty result. Words are compared themselves, not by hashes.
"""

from __future__ import annotations

from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, bound_batches, byte_view, docs_of, give_back, lean, slices

LENGTH = 6
EXPONENT = 4
#: Texts of so many bytes at least are worked on together (one text anyway).
SLICE_BYTES = 1 << 20
SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


class Suffixes:
    """Suffix array, ranks and LCP array over the words of several documents end to end; `ends` holds each word's document end."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, ends: np.ndarray):
        n = len(ids)
        self.n, self.ends = n, ends
        first = doc.astype(np.int64) * (int(ids.max(initial=0)) + 1) + ids
        order = np.argsort(first, kind="stable")
        names, heads = self._names(first[order])
        rank = np.empty(n, dtype=np.int32)
        rank[order] = names
        levels, step, sa = [], 1, order.astype(np.int32)
        open_ = self._open(heads, n)  # slots of the suffix array in groups of two or more
        while len(open_):
            levels.append(rank)
            at = sa[open_]
            on = at + step
            key = rank[at].astype(np.int64) * (n + 1)
            key += np.where(on < ends[at], rank[np.minimum(on, n - 1)] + 1, 0)
            by = np.argsort(key, kind="stable")
            at, key = at[by], key[by]
            sa[open_] = at
            new = np.r_[True, key[1:] != key[:-1]]
            head = np.flatnonzero(new)
            rank = rank.copy()
            rank[at] = np.repeat(open_[head], np.diff(np.r_[head, len(at)]))
            open_ = open_[~(new & np.r_[new[1:], True])]
            step *= 2
        self.sa, self.rank = sa, rank
        self.lcp = self._lcp(levels)
        self.longest = int(np.max(np.diff(np.flatnonzero(np.r_[True, doc[1:] != doc[:-1], True])), initial=1)) if n else 1
        self._least = None

    @staticmethod
    def _names(sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = np.r_[True, sorted_[1:] != sorted_[:-1]]
        heads = np.flatnonzero(new)
        return np.repeat(heads, np.diff(np.r_[heads, len(sorted_)])).astype(np.int32), heads

    @staticmethod
    def _open(heads: np.ndarray, n: int) -> np.ndarray:
        alone = np.zeros(n, dtype=bool)
        alone[heads[np.diff(np.r_[heads, n]) == 1]] = True
        return np.flatnonzero(~alone)

    def _lcp(self, levels: list[np.ndarray]) -> np.ndarray:
        """Common words of each suffix and the one before it in the array: names of doubled prefixes, the longest first."""
        lcp = np.zeros(self.n, dtype=np.int32)
        if not levels:
            return lcp
        slots = np.flatnonzero(levels[0][self.sa[1:]] == levels[0][self.sa[:-1]]) + 1  # the others share no word
        a, b = self.sa[slots - 1], self.sa[slots]
        a_end = self.ends[a]  # the two lie in one document
        got = np.zeros(len(slots), dtype=np.int32)
        for k in range(len(levels) - 1, -1, -1):
            inside = np.flatnonzero((a < a_end) & (b < a_end))
            same = inside[levels[k][a[inside]] == levels[k][b[inside]]]
            got[same] += 1 << k
            a[same] += 1 << k
            b[same] += 1 << k
        lcp[slots] = got
        return lcp

    def previous(self) -> tuple[np.ndarray, np.ndarray]:
        """LPF: for each word, how many from it on also occur from an earlier word of the document on, and from which. The nearest
        suffixes with smaller places, above and below in the array, are found by halving steps over minima of stretches."""
        n, levels = self.n, max(1, self.longest.bit_length())
        far = np.int32(n)
        # places[k, r], common[k, r]: least place and least LCP of slots r .. r + 2^k - 1; asked for whole stretches only
        places, common = np.zeros((levels, n), dtype=np.int32), np.zeros((levels, n), dtype=np.int32)
        places[0], common[0] = self.sa, self.lcp
        for k in range(min(levels - 1, n.bit_length())):
            h = min(1 << k, n)
            np.minimum(places[k, : n - h], places[k, h:], out=places[k + 1, : n - h])
            np.minimum(common[k, : n - h], common[k, h:], out=common[k + 1, : n - h])
        here = np.arange(n, dtype=np.int32)
        lpf, source = np.zeros(n, dtype=np.int32), np.full(n, -1, dtype=np.int32)
        alive = np.flatnonzero((self.lcp > 0) | (np.r_[self.lcp[1:], 0] > 0))  # the others share nothing with a neighbour
        mine = self.sa[alive]
        # upwards: slots left of r while their places are larger
        at, least = here[alive].copy(), np.full(len(alive), far, dtype=np.int32)
        for k in range(levels - 1, -1, -1):
            h = 1 << k
            to = at - h
            ok = np.flatnonzero(to >= 0)
            ok = ok[places[k, to[ok]] > mine[ok]]
            least[ok] = np.minimum(least[ok], common[k, to[ok] + 1])
            at[ok] = to[ok]
        found = at > 0
        to = np.maximum(at - 1, 0)
        least = np.where(found, np.minimum(least, self.lcp[at]), 0)
        up, up_from = least, self.sa[to]
        # downwards
        at, least = here[alive].copy(), np.full(len(alive), far, dtype=np.int32)
        for k in range(levels - 1, -1, -1):
            h = 1 << k
            ok = np.flatnonzero(at + h < n)
            ok = ok[places[k, at[ok] + 1] > mine[ok]]
            least[ok] = np.minimum(least[ok], common[k, at[ok] + 1])
            at[ok] += h
        to = np.minimum(at + 1, n - 1)
        least = np.where(at + 1 < n, np.minimum(least, self.lcp[to]), 0)
        least = np.where(self.sa[to] < mine, least, 0)
        best = np.maximum(up, least)
        lpf[mine], source[mine] = best, np.where(best == 0, -1, np.where(up >= least, up_from, self.sa[to]))
        self._least = common
        return lpf, source

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on and from j on are alike; i and j differ and lie in one document (its end included: none)."""
        out = np.zeros(len(i), dtype=np.int32)
        inside = np.flatnonzero((i < self.n) & (j < self.n))
        a, b = self.rank[i[inside]], self.rank[j[inside]]
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b)
        k = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out[inside] = np.minimum(self._least[k, lo], self._least[k, hi + 1 - (1 << k)])
        return out


def all_runs(ids: np.ndarray, offsets: np.ndarray, length: int = LENGTH, exponent: int = EXPONENT) -> dict[int, list[tuple[int, int, int]]]:
    """ids: words of documents end to end, documents at offsets -> by document with any, its runs (start, length, period), ascending."""
    sizes = np.diff(offsets)
    if not len(ids):
        return {}
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    s = Suffixes(ids, doc, offsets[1:][doc].astype(np.int32))
    if not s.lcp.any():
        return {}
    lpf, source = s.previous()
    blocks = _blocks(lpf, offsets)
    runs = _at_edges(s, ids, doc, blocks, sizes, length, exponent)
    return {d: _copied(found, blocks, d, offsets, source, length) for d, found in runs.items()}


class Blocks:
    """LZ blocks of all documents: block k covers words at[k] .. at[k] + size[k] - 1, those of document d are first[d] .. first[d+1]-1."""

    def __init__(self, at: np.ndarray, size: np.ndarray, first: np.ndarray):
        self.at, self.size, self.first = at, size, first


def _blocks(lpf: np.ndarray, offsets: np.ndarray) -> Blocks:
    step = np.maximum(lpf, 1).tolist()
    at, i, n = [], 0, int(offsets[-1])
    while i < n:  # LPF ends with the document, so blocks do too
        at.append(i)
        i += step[i]
    at = np.array(at, dtype=np.int64)
    return Blocks(at, np.diff(np.r_[at, n]), np.searchsorted(at, offsets))


def _at_edges(s: Suffixes, ids, doc, blocks: Blocks, sizes, length: int, exponent: int) -> dict[int, set[tuple[int, int, int]]]:
    """Main's step: at each block's start, and at each document's end, every period that a wanted run can have there."""
    n = len(ids)
    full = np.flatnonzero(sizes > 0)
    tail = np.cumsum(sizes)[full]  # document ends: edges with an empty block behind
    edge = np.r_[blocks.at, tail]
    of = np.r_[doc[blocks.at], full]
    first = np.zeros(len(blocks.at), dtype=bool)
    first[blocks.first[:-1][full]] = True
    before = np.where(first, 0, np.r_[0, blocks.size[:-1]])
    last = blocks.size[blocks.first[1:][full] - 1]
    reach = np.r_[before + blocks.size, last]
    most = np.maximum(reach - 1, 0) // (exponent - 1)
    most[most - 1 + reach < length] = 0
    spots = np.flatnonzero(most > 0)
    found: dict[int, set[tuple[int, int, int]]] = {}
    begins, ends, room = np.cumsum(sizes) - sizes, np.cumsum(sizes), 1 << 20
    cuts = np.r_[0, np.flatnonzero(np.diff(np.cumsum(most[spots]) // room)) + 1, len(spots)]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        part = spots[lo:hi]
        if not len(part):
            continue
        for a in range(1, int(most[part].max()) + 1, room):  # a single edge may have more periods than fit
            todo = np.clip(most[part] - a + 1, 0, room)
            at = np.repeat(edge[part], todo)
            d = np.repeat(of[part], todo)
            p = np.arange(len(at)) - np.repeat(np.cumsum(todo) - todo, todo) + a
            begin, end = begins[d], ends[d]
            for left, right in ((at, at + p), (at - p, at)):  # the run's words p apart lie on both sides of (left, right)
                _extended(s, ids, left, right, begin, end, p, d, found, length, exponent)
    return found


def _extended(s: Suffixes, ids, left, right, begin, end, p, d, found, length: int, exponent: int) -> None:
    n = len(ids)
    ok = np.flatnonzero((left >= begin) & (right <= end))
    same = (right[ok] < end[ok]) & (ids[np.minimum(left[ok], n - 1)] == ids[np.minimum(right[ok], n - 1)])
    back = (left[ok] > begin[ok]) & (ids[np.maximum(left[ok] - 1, 0)] == ids[np.maximum(right[ok] - 1, 0)])
    keep = same | back
    ok, same = ok[keep], same[keep]
    forward = np.zeros(len(ok), dtype=np.int64)
    at = np.flatnonzero(same)
    forward[at] = s.common(left[ok[at]], right[ok[at]])
    period = p[ok]
    need = np.maximum(np.maximum((exponent - 1) * period, length - period) - forward, 0)  # words that must be alike to the left
    good = left[ok] - need >= begin[ok]
    ok, forward, need, period = ok[good], forward[good], need[good], period[good]
    asks = np.flatnonzero(need > 0)
    wide = np.ones(len(ok), dtype=bool)
    wide[asks] = s.common(left[ok[asks]] - need[asks], right[ok[asks]] - need[asks]) >= need[asks]
    ok, forward, need, period = ok[wide], forward[wide], need[wide], period[wide]
    if not len(ok):
        return
    # how far to the left: m words are alike there iff m words from m places before are
    lo, hi = need.astype(np.int64), (left[ok] - begin[ok]).astype(np.int64)
    while True:
        at = np.flatnonzero(lo < hi)
        if not len(at):
            break
        mid = (lo[at] + hi[at] + 1) // 2
        fits = s.common(left[ok[at]] - mid, right[ok[at]] - mid) >= mid
        lo[at] = np.where(fits, mid, lo[at])
        hi[at] = np.where(fits, hi[at], mid - 1)
    start = left[ok] - lo - begin[ok]
    whole = lo + forward + period
    rows = np.unique(np.stack([d[ok], start, whole, period], axis=1), axis=0)
    best: dict[tuple[int, int, int], int] = {}
    for k, a, w, q in rows.tolist():
        best.setdefault((k, a, w), q)  # ascending periods: the smallest stays
    for (k, a, w), q in best.items():
        found.setdefault(k, set()).add((a, w, q))


def _copied(found: set[tuple[int, int, int]], blocks: Blocks, d: int, offsets, source, length: int) -> list[tuple[int, int, int]]:
    """Runs at edges and their copies inside blocks, ascending. Buckets of runs by start are filled from left to right, so a block's source is complete before the block."""
    least: dict[tuple[int, int], int] = {}
    for a, w, q in found:
        least[a, w] = min(q, least.get((a, w), q))
    base = int(offsets[d])
    lo, hi = int(blocks.first[d]), int(blocks.first[d + 1])
    edges = sorted((a, w, q) for (a, w), q in least.items())
    runs, known, taken = [], set(), 0
    for k in range(lo, hi):
        at, size = int(blocks.at[k]) - base, int(blocks.size[k])
        while taken < len(edges) and edges[taken][0] <= at:
            if edges[taken] not in known:
                known.add(edges[taken])
                insort(runs, edges[taken])
            taken += 1
        if size < length + 2:
            continue
        # runs that start inside the block and meet its end belong to the next edge; those of the source may lie in this very block
        src = int(source[blocks.at[k]]) - base
        upto = src + size - 1
        i = bisect_right(runs, (src + 1, -1, -1))
        while True:
            # the source may reach into the block itself: copies made here are read again, in order of start
            if i >= len(runs) or runs[i][0] >= upto:
                break
            a, w, q = runs[i]
            i += 1
            if a + w < src + size:  # strictly inside
                copy = (a - src + at, w, q)
                if copy not in known:
                    known.add(copy)
                    insort(runs, copy)
    for x in edges[taken:]:
        if x not in known:
            insort(runs, x)
    return runs


def drop_mask(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of a document's words stay: those in no run, or in its first period only."""
    gone = np.zeros(n + 1, dtype=np.int32)
    for a, w, q in runs:
        gone[a + q] += 1
        gone[a + w] -= 1
    return np.cumsum(gone[:-1]) == 0


def _task(length: int, exponent: int):
    def work(batches):
        lean()
        for batch in batches:
            for part in slices(batch, most=SLICE_BYTES):
                yield _slice(part, length, exponent)
        give_back()

    return work


def _slice(part: pa.RecordBatch, length: int, exponent: int) -> pa.RecordBatch:
    data, at = byte_view(part.column(part.schema.get_field_index("text")))
    raw = data.tobytes()
    words = [raw[a:z].split() for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    offsets = np.r_[0, np.cumsum([len(w) for w in words])].astype(np.int64)
    flat = [x for w in words for x in w]
    ids = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy() if flat else np.zeros(0, np.int32)
    runs = all_runs(ids, offsets, length, exponent)
    out = []
    for d, w in enumerate(words):
        if d in runs:
            stays = drop_mask(len(w), runs[d])
            w = [x for x, s in zip(w, stays.tolist(), strict=True) if s]
        out.append(b" ".join(w))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    rows = [[{"start": a, "length": w, "period": q} for a, w, q in runs.get(d, ())] for d in range(len(words))]
    collapsed = pa.array(out, pa.binary()).view(pa.string())
    return pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("doc_id")), pa.array(np.diff(offsets)), pa.array(rows, kind), collapsed], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(documents: DataFrame, length: int = LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (start, length, period of each, by start, then period), collapsed: the text's words joined by one space, of
    each run its first period alone."""
    if exponent < 2 or length < 1:
        raise ValueError("runs have at least two periods")
    bound_batches(documents.sparkSession)
    return docs_of(documents).select("doc_id", "text").mapInArrow(_task(length, exponent), SCHEMA)


def planted(documents: DataFrame) -> DataFrame:
    """The query's texts: in every document whose id's crc32 ends in 0, words from a place on repeat a stretch from there."""
    docs = docs_of(documents).select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", f"{SPACE}+"), "")
    w = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    w = w.withColumn("a", F.when(n > 0, (g % n).cast("int"))).withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    moved = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return w.select("doc_id", F.when(n > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def run_digest(documents: DataFrame) -> DataFrame:
    """The query's rows: each document's number of runs, its longest one, and digests of all runs and of the collapsed text."""
    found = periodic_runs(planted(documents))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", *_longest(F.col("best")), "runs_sha256", "collapsed_sha256")


def _longest(best: Column) -> list[Column]:
    start, length, period = -best["start"], best["length"], -best["period"]
    return [start.alias("start"), length.alias("length"), period.alias("period"), F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli")]
