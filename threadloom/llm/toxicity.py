"""Operator 6: toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two words adds decay**span over their common subsequences of ORDER letters, for each by its tightest occurrence, so
an insult with letters put in, marks between its letters or blanks between them (runs of single letters are read as one word) still
matches. Landmarks are letter groups that labelled toxic sentences hold, in words of many different surroundings, and clean ones
don't, found by greedy cover. A word's features are its kernel values against the landmarks, relative to the landmarks' own; a
sentence keeps the largest value of its words for each landmark, a text that of its sentences. What clean texts reach by chance is
taken off (FLOOR at least), and what is left is whitened by the landmarks' own kernel matrix: the Nyström features. Only words that
provably stay below FLOOR, by the letters they hold, are not compared. A linear machine on these is trained with squared hinge loss,
and its output turned into a probability by a logistic fit. Among its training rows are the landmarks with letters put in.

Training takes at most FIT_TOXIC and FIT_CLEAN labelled texts (by the crc32 of their ids) of at most FIT_BYTES in all: a bounded,
documented sample; texts that don't fit any more are passed over, each class within its part of the bytes first. Every text is scored whole.

Cases: a null or empty text has no word and gets the machine's value at zero; without labels of both kinds every score is the
share of toxic labels learned from (0 without any); null labels are not learned from; a doc_id labelled twice is toxic if one
label says so; repeated rows are scored each; a very long text is read in whole, and so is a very long word: it is worked through in
stretches that overlap by SPAN letters, and of each subsequence the tightest occurrence in any of them counts; one wider than SPAN
letters would add less than 10^-6 of itself;
ties in the sample's order go by doc_id and text; other columns, whatever their names, don't matter; rows with a null doc_id are
left out; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, bound_batches, byte_view, crc_mod, docs_of, give_back, lean, ragged, slices, word_spans

ORDER = 4
DECAY = 0.8
#: Landmarks at most; lengths of the letter groups; share of clean texts a group may be in.
LANDMARKS = 48
GROUP = (4, 5, 6, 7, 8)
CLEAN_SHARE = 0.001
LEAST_TEXTS, LEAST_SHARE = 3, 0.025
#: Words whose kernel is worked out at a time; the least value that counts.
STEP, FLOOR = 1024, 0.3
FIT_TOXIC, FIT_CLEAN, FIT_BYTES = 1000, 2000, 10 << 20
#: Ids looked at for each one taken: some have no text, or one that doesn't fit.
SPARE = 4
#: Texts of the sample whose features are made at a time (of sentences fifty times as many).
FIT_STEP = 300
#: Letters of a long word in one stretch, and letters that stretches have in common: occurrences that are wider weigh DECAY**SPAN < 10^-6.
WIDE, SPAN = 192, 64
#: Words up to so many letters are worked on apart from longer ones, so these don't pad them.
SHORT = 24
THRESHOLD = 0.3
SENTENCE = re.compile(r"[.!?\n]+")
#: Kernel value from which a sentence of a toxic text is taken as toxic itself; value above the background from which a landmark with letters put in is.
SPEAKS, HEARD = 0.9, 0.1
#: Share of the clean texts that go beyond a landmark's background.
BACKGROUND = 0.0005


def letters_of(word: str) -> str:
    word = word.lower()
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def pieces_of(words: list[str]) -> list[str]:
    """Letters of each word; a run of single letters is one word more."""
    out, run = [], []
    for w in [*words, ""]:
        x = letters_of(w)
        if len(x) == 1:
            run.append(x)
            continue
        if len(run) >= ORDER:
            out.append("".join(run))
        if w and x or not w:
            run = []
        if x:
            out.append(x)
    return out


def subsequences(mark: str, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The different subsequences of `order` letters of a landmark, as places in it (the tightest, leftmost ones), and their spans."""
    found: dict[str, tuple[int, ...]] = {}
    for at in combinations(range(len(mark)), order):
        u = "".join(mark[i] for i in at)
        if u not in found or at[-1] - at[0] < found[u][-1] - found[u][0]:
            found[u] = at
    places = np.array(list(found.values()), dtype=np.int64).reshape(-1, order)
    return places, places[:, -1] - places[:, 0] + 1


def tightest(words: np.ndarray, lengths: np.ndarray, mark: np.ndarray, places: np.ndarray) -> np.ndarray:
    """(words, subsequences): the span of the tightest occurrence of each of a landmark's subsequences in padded words of letter codes,
    1000 where there is none.

    start[i] is, for every word and subsequence, where the latest occurrence of its first i + 1 letters begins.
    """
    n, u = len(words), len(places)
    start = np.full((places.shape[1], n, u), -1000, dtype=np.int16)
    best = np.full((n, u), 1000, dtype=np.int16)
    for s in range(words.shape[1]):
        same = (words[:, s : s + 1] == mark) & (s < lengths)[:, None]
        last = same[:, places[:, -1]]
        np.minimum(best, s + 1 - start[-2], out=best, where=last)
        for i in range(places.shape[1] - 2, 0, -1):
            np.copyto(start[i], start[i - 1], where=same[:, places[:, i]])
        np.copyto(start[0], np.int16(s), where=same[:, places[:, 0]])
    return best


def weighed(best: np.ndarray, spans: np.ndarray, decay: float = DECAY) -> np.ndarray:
    return decay ** best.astype(np.float32) @ (decay ** spans.astype(np.float32))


def kernel(words: np.ndarray, lengths: np.ndarray, mark: np.ndarray, places: np.ndarray, spans: np.ndarray, decay: float = DECAY) -> np.ndarray:
    """Gap-weighted subsequence kernel of padded words of letter codes with one landmark: the sum over its subsequences of decay**span in
    the word times decay**span in the landmark. A subsequence counts by its tightest occurrence, not by the sum over all of them as in
    the textbook's kernel, so a word that repeats some letters does not add up to one that holds them all."""
    return weighed(tightest(words, lengths, mark, places), spans, decay)


def coded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of words, padded with 0 to the longest, and their lengths."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    wide = int(lengths.max(initial=0))
    out = np.zeros((len(words), wide), dtype=np.uint16)
    flat = np.frombuffer("".join(words).encode("utf-16-le", "surrogatepass"), dtype=np.uint16)
    if len(flat) == lengths.sum():
        out[np.arange(wide)[None, :] < lengths[:, None]] = flat
    else:  # letters beyond the first plane
        for i, w in enumerate(words):
            out[i, : lengths[i]] = [min(ord(c), 65535) for c in w]
    return out, lengths


def stretches(words: list[str]) -> tuple[list[str], np.ndarray]:
    """The words, long ones in stretches of WIDE letters that have SPAN in common with the next, and where each word's begin."""
    if all(len(w) <= WIDE for w in words):
        return words, np.arange(len(words) + 1)
    cut = [[w[i : i + WIDE] for i in range(0, max(1, len(w) - SPAN), WIDE - SPAN)] for w in words]
    return [x for c in cut for x in c], np.r_[0, np.cumsum([len(c) for c in cut])]


class Kernel:
    """How much of each landmark's kernel with itself words hold: 1 for a word that holds it whole, less for each letter between."""

    def __init__(self, marks: list[str]):
        self.marks = marks
        self.codes = [np.array([min(ord(c), 65535) for c in m], dtype=np.uint16) for m in marks]
        self.parts = [subsequences(m) for m in marks]
        self.own = np.array([(DECAY ** (2.0 * spans)).sum() for _, spans in self.parts])
        self.bounds = [self._bounds(j) for j in range(len(marks))]
        w, n = coded(marks)
        self.gram = np.array([kernel(w, n, c, *p) for c, p in zip(self.codes, self.parts, strict=True)]) / np.sqrt(np.outer(self.own, self.own)) if marks else np.zeros((0, 0))
        values, vectors = np.linalg.eigh(self.gram) if marks else (np.zeros(0), np.zeros((0, 0)))
        self.whiten = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T

    def _bounds(self, j: int) -> np.ndarray:
        """For each set of a landmark's places the most that a word can reach which holds only letters for these: no span in a word
        is below ORDER, and a subsequence whose letters are not held adds nothing."""
        places, spans = self.parts[j]
        marks = self.marks[j]
        letters = [Counter(marks[i] for i in at) for at in places.tolist()]
        out = np.zeros(1 << len(marks))
        for held in range(1 << len(marks)):
            have = Counter(marks[i] for i in range(len(marks)) if held >> i & 1)
            able = [all(have[c] >= k for c, k in need.items()) for need in letters]
            out[held] = (DECAY ** (ORDER + spans[able])).sum() / self.own[j]
        return out

    def values(self, words: list[str]) -> np.ndarray:
        """(words, landmarks); words that cannot reach FLOOR, by the letters they hold, have 0 there, and nothing counts below it."""
        out = np.zeros((len(words), len(self.marks)), dtype=np.float32)
        if words and self.marks:
            lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            for rows in (np.flatnonzero(lengths <= SHORT), np.flatnonzero(lengths > SHORT)):
                rows = rows[np.argsort(lengths[rows], kind="stable")]  # words of about one length together: less padding
                if len(rows):
                    out[rows] = self._values([words[i] for i in rows.tolist()])
        return out

    def _values(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.marks)), dtype=np.float32)
        parts, first = stretches(words)
        codes, lengths = coded(parts)
        # of a long word letters that stretches share count twice: its bound is the looser
        count = lambda c: np.minimum(np.add.reduceat(np.count_nonzero(codes == c, axis=1), first[:-1]), 127).astype(np.int8)
        counts = {c: count(c) for c in set(np.concatenate(self.codes).tolist())}
        for j, mark in enumerate(self.codes):
            held = np.zeros(len(words), dtype=np.int16)
            seen: Counter[int] = Counter()
            for i, c in enumerate(mark.tolist()):  # the k-th place of a letter is held by words with k of it
                held |= (counts[c] > seen[c]).astype(np.int16) << i
                seen[c] += 1
            near = np.flatnonzero(self.bounds[j][held] >= FLOOR)
            sizes = first[near + 1] - first[near]
            cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - 1) // STEP)) + 1
            for some, n in zip(np.split(near, cuts), np.split(sizes, cuts), strict=True):
                if not len(some):
                    continue
                rows = ragged(first[some], n)
                best = tightest(codes[rows, : lengths[rows].max()], lengths[rows], mark, self.parts[j][0])
                if len(rows) > len(some):
                    best = np.minimum.reduceat(best, np.cumsum(n) - n, axis=0)
                got = weighed(best, self.parts[j][1]) / self.own[j]
                out[some, j] = np.where(got >= FLOOR, got, 0)
        return out


def unlike(texts: list[set[str]], hashes: int = 8) -> list[set[str]]:
    """Texts of which no earlier one is a near copy (half of eight min-hashes of the words in common): copies would make any of their words look telling."""
    seen: list[set[int]] = [set() for _ in range(hashes)]
    out = []
    for words in texts:
        codes = np.fromiter((zlib.crc32(w.encode()) for w in words), dtype=np.uint64)
        marks = [int((codes * np.uint64(2 * k + 0x9E3779B1) % np.uint64(4294967291)).min()) for k in range(hashes)] if len(codes) else []
        if sum(m in s for m, s in zip(marks, seen, strict=False)) * 2 < hashes:
            out.append(words)
        for m, s in zip(marks, seen, strict=False):
            s.add(m)
    return out


def landmarks(toxic: list[set[str]], clean: list[set[str]], most: int = LANDMARKS, contexts: dict[str, tuple[set[str], set[str]]] | None = None) -> list[str]:
    """Letter groups by greedy cover of the words of toxic texts: each next one is in the most toxic texts, in words that hold
    no earlier one, and in next to no clean text; longer groups win near ties. With `contexts`, a group needs different words
    before and behind it, a quarter as many as it is in texts: what recurs in one and the same passage only says that it was copied."""
    toxic = unlike(toxic)
    parts = lambda w: {w[i : i + n] for n in GROUP for i in range(len(w) - n + 1)}
    least = max(LEAST_TEXTS, LEAST_SHARE * len(toxic))
    # texts by hash first: only groups that can be in enough of them are kept by name
    rough = np.zeros(1 << 20, dtype=np.int32)
    slot = lambda g: hash(g) & (len(rough) - 1)
    for words in toxic:
        rough[np.unique(np.fromiter((slot(g) for w in words for g in parts(w)), dtype=np.int64))] += 1
    bad: Counter[str] = Counter()
    for words in toxic:
        bad.update({g for w in words for g in parts(w) if rough[slot(g)] >= least})
    likely = {g for g, n in bad.items() if n >= least}
    good: Counter[str] = Counter()
    for words in clean:
        good.update({g for w in words for g in parts(w)} & likely)
    limit = CLEAN_SHARE * len(clean)
    usable = {g for g in likely if good[g] <= limit}
    if contexts is not None:
        around: dict[str, tuple[set[str], set[str]]] = {g: (set(), set()) for g in usable}
        for w, sides in contexts.items():
            for g in parts(w) & usable:
                for mine, more in zip(around[g], sides, strict=True):
                    mine.update(more)
        usable = {g for g in usable if min(map(len, around[g])) >= max(LEAST_TEXTS, bad[g] / 4)}
    where: dict[str, set[int]] = {}
    for k, words in enumerate(toxic):
        for w in words:
            if w in where or not usable.isdisjoint(parts(w)):
                where.setdefault(w, set()).add(k)
    own = {w: parts(w) & usable for w in where}
    chosen: list[str] = []
    while len(chosen) < most:
        tally: dict[str, set[int]] = {}
        for w, gs in own.items():
            for g in gs:
                tally.setdefault(g, set()).update(where[w])
        if not tally:
            break
        best = min(tally, key=lambda g: (-len(tally[g]) * (1 + 0.1 * len(g)), g))
        if len(tally[best]) < least:
            break
        chosen.append(best)
        own = {w: gs for w, gs in own.items() if best not in gs}
    return chosen


def train(x: np.ndarray, y: np.ndarray, cost: float = 20.0, rounds: int = 800) -> tuple[np.ndarray, float]:
    """Squared-hinge linear machine by accelerated gradient steps; both classes weigh alike."""
    sign = np.where(y > 0, 1.0, -1.0)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) * len(y)
    z = np.c_[x, np.ones(len(x))]
    keep = np.r_[np.ones(x.shape[1]), 0.0] / len(y)
    step = 1.0 / (2 * cost * np.linalg.norm(z * np.sqrt(weight)[:, None], 2) ** 2 / len(y) + 1.0)
    w = v = np.zeros(z.shape[1])
    for t in range(rounds):
        slack = np.maximum(0, 1 - sign * (z @ v))
        grad = keep * v - 2 * cost / len(y) * (z.T @ (weight * sign * slack))
        new = v - step * grad
        v = new + t / (t + 3) * (new - w)
        w = new
    return w[:-1], float(w[-1])


def squashed(margin: np.ndarray) -> np.ndarray:
    """Margins in the same order between -1 and 1: beyond the machine's own margin of 1 more of it says little."""
    return margin / (1 + np.abs(margin))


def logistic(margin: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Platt's slope and offset by Newton steps, with his smoothed targets."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, float(np.log((pos + 1) / (neg + 1)))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        r = p * (1 - p) + 1e-9
        grad = np.array([((p - target) * margin).sum(), (p - target).sum()])
        hess = np.array([[(r * margin**2).sum() + 1e-6, (r * margin).sum()], [(r * margin).sum(), r.sum() + 1e-6]])
        da, db = np.linalg.solve(hess, grad)
        a, b = a - np.clip(da, -5, 5), b - np.clip(db, -5, 5)
    return float(a), float(b)


def background(clean: np.ndarray) -> np.ndarray:
    """Of each landmark the value that BACKGROUND of the clean texts go beyond: what words reach by chance, much for short landmarks of common letters."""
    if not len(clean):
        return np.full(clean.shape[1], FLOOR, dtype=np.float32)
    beyond = min(len(clean) - 1, int(BACKGROUND * len(clean)))
    return np.clip(np.sort(clean, axis=0)[len(clean) - 1 - beyond], np.float32(FLOOR), np.float32(0.95))


def above(features: np.ndarray, ground: np.ndarray) -> np.ndarray:
    """What stands out of the background, 1 for a landmark held whole."""
    return np.maximum(features - ground, 0) / (1 - ground)


class Model:
    """What scores a text: kernel, background, whitening, machine, logistic."""

    def __init__(self, kernel_: Kernel, ground: np.ndarray, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.kernel, self.ground = kernel_, ground
        self.direct = kernel_.whiten @ weights if len(kernel_.marks) else np.zeros(0)
        self.bias, self.slope, self.offset = bias, slope, offset

    def score(self, features: np.ndarray) -> np.ndarray:
        margin = squashed(above(features, self.ground) @ self.direct + self.bias)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def text_features(texts: pa.Array, kern: Kernel) -> np.ndarray:
    """(texts, landmarks): the largest kernel value of any word. Equal words of the batch are compared once."""
    data, offsets = byte_view(texts)
    starts, ends, at = word_spans(data, offsets)
    out = np.zeros((len(offsets) - 1, len(kern.marks)), dtype=np.float32)
    if not len(starts) or not kern.marks:
        return out
    data = LOWER[data]
    bounds = np.r_[starts, len(data)].astype(np.int64)
    # a word with the blanks behind it: still one key for each distinct word, up to its blanks
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(data.tobytes())]).dictionary_encode()
    which = words.indices.to_numpy()
    pieces, of = [], []
    single, blank = np.zeros((2, len(words.dictionary)), dtype=bool)
    names = [w.decode("utf-8", "ignore") for w in words.dictionary.to_pylist()]
    for i, w in enumerate(names):
        x = letters_of(w)
        if len(x) == 1:
            single[i] = True
        elif not x:
            blank[i] = True
        elif len(x) >= ORDER:
            pieces.append(x)
            of.append(i)
    best = np.zeros((len(names), len(kern.marks)), dtype=np.float32)
    if pieces:
        kinds = {p: k for k, p in enumerate(dict.fromkeys(pieces))}
        values = kern.values(list(kinds))
        rows = np.array([kinds[p] for p in pieces])
        hot = np.flatnonzero(values.any(1)[rows])
        np.maximum.at(best, np.array(of)[hot], values[rows[hot]])
    owner = np.searchsorted(at, np.arange(len(starts)), side="right") - 1
    hits = np.flatnonzero(best.any(1)[which])
    np.maximum.at(out, owner[hits], best[which[hits]])
    # runs of single letters; words without letters may stand between
    alone = single[which]
    lone = alone | blank[which]
    edge = np.flatnonzero(np.diff(np.r_[0, lone.view(np.int8), 0]))
    before = np.r_[0, np.cumsum(alone)]
    runs, rows = [], []
    for a, z in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        if before[z] - before[a] >= ORDER:
            for row in range(owner[a], owner[z - 1] + 1):  # a run ends with its text
                for p in pieces_of([names[which[k]] for k in range(max(a, at[row]), min(z, at[row + 1]))]):
                    if len(p) >= ORDER:
                        runs.append(p)
                        rows.append(row)
    if runs:
        np.maximum.at(out, np.array(rows), kern.values(runs))
    return out


def contexts_of(texts: list[list[str]]) -> dict[str, tuple[set[str], set[str]]]:
    """For each word the different words before it and behind it in the texts."""
    out: dict[str, tuple[set[str], set[str]]] = {}
    for words in texts:
        for before, w, after in zip(["", *words], words, [*words[1:], ""], strict=False):
            sides = out.setdefault(w, (set(), set()))
            sides[0].add(before)
            sides[1].add(after)
    return out


def put_in(mark: str) -> list[str]:
    """The landmark with a letter put in, at every place, and with one between any two: what the kernel has to tolerate."""
    return [mark[:i] + "\0" + mark[i:] for i in range(1, len(mark))] + ["\0".join(mark)]


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    names: dict[str, str] = {}  # one string for each distinct word of all texts
    words = [[names.setdefault(w, w) for w in pieces_of(t.split())] for t in texts]
    y = np.asarray(toxic)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.0, 1e-9, 1 - 1e-9))
        return Model(Kernel([]), np.zeros(0), np.zeros(0), 0.0, 0.0, float(np.log(share / (1 - share))) if len(y) else -30.0)
    bad, good = ([w for w, t in zip(words, y, strict=True) if bool(t) is x] for x in (True, False))
    marks = landmarks([set(w) for w in bad], [set(w) for w in good], contexts=contexts_of(bad))
    del words, names, bad, good
    kern = Kernel(marks)
    features = lambda ts, step: np.concatenate([text_features(pa.array(ts[i : i + step], pa.string()), kern) for i in range(0, len(ts), step)] or [np.zeros((0, len(marks)), dtype=np.float32)])
    x = features(texts, FIT_STEP)
    ground = background(x[y <= 0])
    # sentences of toxic texts stand alone where a landmark speaks, so none leans on its company; clean texts hold clean sentences only
    sentences = [q for t, is_bad in zip(texts, y, strict=True) if is_bad for q in SENTENCE.split(t)]
    alone = features(sentences, 50 * FIT_STEP)
    alone = np.unique(alone[alone.max(1, initial=0) >= SPEAKS], axis=0)
    gapped = kern.values([g for m in marks for g in put_in(m)])
    alone = np.concatenate([alone, gapped[above(gapped, ground).max(1, initial=0) >= HEARD]])
    z, y = above(np.concatenate([x, alone]), ground) @ kern.whiten, np.r_[y, np.ones(len(alone), dtype=y.dtype)]
    weights, bias = train(z, y)
    return Model(kern, ground, weights, bias, *logistic(squashed(z @ weights + bias), y))


def sampled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The bounded labelled sample (key, doc_id, text, toxic, times): ids and sizes first, then only the texts that are taken."""
    spark = documents.sparkSession
    lab = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    lab = lab.filter(crc_mod("doc_id", 4) != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    key = F.crc32(F.concat(F.lit("fit "), F.col("doc_id").cast("string")).cast("binary"))
    take = lambda t, n: lab.filter("toxic > 0" if t else "toxic <= 0").orderBy(key, "doc_id").limit(n)
    ids = take(1, SPARE * FIT_TOXIC).unionByName(take(0, SPARE * FIT_CLEAN))
    docs = docs_of(documents).filter("text IS NOT NULL").withColumn("text_key", F.xxhash64("text"))
    sizes = docs.select("doc_id", "text_key", F.octet_length("text").alias("bytes")).filter(F.col("bytes") <= FIT_BYTES).join(F.broadcast(ids), "doc_id").withColumn("key", key)
    # all texts of some labelled ids are small in number unless rows repeat: as many as can be wanted
    kept = chosen([(r["doc_id"], r["text_key"], r["bytes"], r["toxic"] > 0) for t in (True, False) for r in sizes.filter("toxic > 0" if t else "toxic <= 0").orderBy("key", "doc_id", "text_key").limit(SPARE * (FIT_TOXIC if t else FIT_CLEAN)).collect()])
    wanted = spark.createDataFrame([(*k, n) for k, n in kept.items()], "doc_id bigint, text_key bigint, times int")
    got = docs.join(F.broadcast(wanted), ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"]).join(F.broadcast(ids), "doc_id").withColumn("key", key)
    return got.select("key", "doc_id", "text", "toxic", "times")


def _in_order(rows: list[tuple]) -> tuple[list[str], np.ndarray]:
    """Texts and labels of the sample's rows, as often as they were drawn."""
    rows = [r for r in sorted(rows, key=lambda r: r[:3]) for _ in range(r[4])]
    return [r[2] for r in rows], np.array([int(r[3] > 0) for r in rows], dtype=np.int64)


def sample(documents: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """The sample's texts and labels."""
    return _in_order([tuple(r) for r in sampled(documents, labels).collect()])


def fitted(documents: DataFrame, labels: DataFrame) -> Model:
    """The model, fitted in one task on the bounded sample; what comes to the driver are landmarks and weights."""
    bound_batches(documents.sparkSession)

    def run(batches):
        lean()
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        model = pickle.dumps(fit(*_in_order(rows)))
        rows.clear()
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    got = sampled(documents, labels).repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(got["model"]) if got else fit([], np.zeros(0))


def chosen(rows: list[tuple[int, int, int, bool]]) -> Counter:
    """Of (doc_id, text_key, bytes, toxic), in order, those to learn from: each class has its part of the bytes, a text that doesn't fit is passed over, and room that is left goes to those passed over."""
    kept: Counter = Counter()
    left, room, over = {True: FIT_TOXIC, False: FIT_CLEAN}, {t: FIT_BYTES * n // (FIT_TOXIC + FIT_CLEAN) for t, n in ((True, FIT_TOXIC), (False, FIT_CLEAN))}, []
    for row in rows:
        if row[2] > room[row[3]]:
            over.append(row)
        elif left[row[3]]:
            kept[row[:2]] += 1
            left[row[3]] -= 1
            room[row[3]] -= row[2]
    spare = sum(room.values())
    for row in over:
        if row[2] <= spare and left[row[3]]:
            kept[row[:2]] += 1
            left[row[3]] -= 1
            spare -= row[2]
    return kept


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """documents(doc_id, text) -> doc_id, text_key, score."""
    spark = documents.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # LANDMARKS words and weights

    def run(batches):
        lean()
        m = shared.value
        for whole in batches:
            for b in slices(whole, most=8 << 20):
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(m.score(text_features(b.column(2), m.kernel)), pa.float64())], names=["doc_id", "text_key", "score"])
        give_back()

    docs = docs_of(documents).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return docs.mapInArrow(run, "doc_id bigint, text_key bigint, score double")


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model = fitted(documents, labels)
    out = scored(documents, model)
    return out.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, whose score is below the threshold; texts are scored where they are read, so nothing is shuffled."""
    spark = documents.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(fitted(documents, labels))
    at = documents.columns.index("text")

    def run(batches):
        lean()
        m = shared.value
        for whole in batches:
            for b in slices(whole, most=8 << 20):
                yield b.filter(pa.array(m.score(text_features(b.column(at).cast(pa.string()), m.kernel)) < threshold))
        give_back()

    return documents.mapInArrow(run, documents.schema)
