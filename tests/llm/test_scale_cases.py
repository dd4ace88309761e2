"""Hot keys, repeated ids, very long texts and recursion, each held against brute force."""

import math
import os
import random
import time
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from threadloom.llm import additive, cube, jaccard, langid, ppm, quality, sp_bpe, superkmer, toxicity, wavelet
from threadloom.llm.queries import tokenizer_file

from . import brute
from .test_operators import SCHEMA, plain_kernel, toxic_texts, vocabulary


def say(r, v, n):
    return " ".join(r.choice(v) for _ in range(n))


@pytest.fixture(scope="module")
def families():
    """Families of near copies at all distances that share passages, and a phrase that is in every text."""
    r, v = random.Random(5), vocabulary(5, 80)
    rows, phrase = [], say(r, v, 9)
    for _ in range(7):
        base = [r.choice(v) for _ in range(r.choice([15, 40, 120]))]
        for _ in range(14):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 10))):
                w[r.randrange(len(w))] = r.choice(v)
            rows.append((len(rows), phrase + " " + " ".join(w[r.randint(0, 4) :])))
    return rows + [(len(rows), phrase), (len(rows) + 1, phrase.upper())]


@pytest.mark.parametrize("group,depth", [(4, 4), (4, 2), (10, 3), (4, 1)])
def test_jaccard_recursion_and_hot_shingles(spark, families, group, depth, monkeypatch):
    d = spark.createDataFrame(families, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(jaccard, "SLICE", 4000)
    monkeypatch.setattr(jaccard, "DEPTH", depth)
    real = jaccard.links
    monkeypatch.setattr(jaccard, "links", lambda sets, folder, percent: real(sets, folder, percent, group=group, depth=depth))
    assert sorted(map(tuple, jaccard.jaccard_join(d).collect())) == brute.components(families)


def test_hot_shingles_meet_without_a_bucket(spark, families, tmp_path):
    d = spark.createDataFrame(families, "doc_id long, text string").repartition(2)
    rows = jaccard.nodes_of(jaccard.docs_of(d))
    hot = jaccard.heavy(rows.filter("doc_id IS NULL").selectExpr("node AS hash", "n_shingles AS n"), len(families), 0.5, 100)
    assert 0 < len(hot[0]) <= 100  # the phrase's shingles
    none = (hot[0][:0], hot[1][:0])
    with_, without = (sorted((r["node"], r["shared"], bytes(r["shingles"])) for r in jaccard.candidates(jaccard.shared_shingles(jaccard.docs_of(d), x, 1 << 20)).collect()) for x in (hot, none))
    assert with_ == without


def test_one_of_each_with_repeated_ids(spark):
    a, b = "one two three four five six seven", "red green blue black white grey pink"
    rows = [(5, a, "x"), (5, b, "x"), (3, b, "x"), (9, a, "x"), (9, a, "y"), (7, None, "x"), (7, None, "x"), (8, " ", "x"), (4, "alone", "z"), (4, "alone", "y")]
    d = spark.createDataFrame([(i, t, lang, None, 1, "t", "n", 1, "z", "k", 2, 3, 4, 0.5, 6) for i, t, lang in rows], SCHEMA)
    kept = jaccard.one_of_each(d)
    assert kept.columns == d.columns
    assert sorted(((r["doc_id"], r["text"], r["lang"]) for r in kept.collect()), key=str) == sorted([(5, a, "x"), (3, b, "x"), (7, None, "x"), (8, " ", "x"), (4, "alone", "y")], key=str)


@pytest.mark.parametrize("share", [2e-5, 0.002])
def test_a_seed_in_every_document(spark, families, share, monkeypatch):
    monkeypatch.setattr(superkmer, "SHARE", share)
    monkeypatch.setattr(superkmer, "SLICE", 3000)
    monkeypatch.setattr(superkmer, "STRIP", 2000)
    d = spark.createDataFrame(families, "doc_id long, text string").repartition(3)
    assert len(superkmer.frequent_seeds(superkmer.docs_of(d)))
    assert sorted(map(tuple, superkmer.substring_dedup(d).collect())) == brute.substring_dedup(families)


def test_mixing_stage_is_the_same_again(spark):
    import corpus_pipeline as p

    rows = [(1, "a b c", "en", "s", 5), (1, "a b c", "fr", "s", 5), (1, "a b c", None, "s", 6), (2, None, "en", None, None), (3, "x y z w", "en", "t", 7), (3, "other text", "en", "t", 7)] + [(k, "w " * k, "en", "u", k) for k in range(10, 60)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    one, two = (sorted(map(str, p.mixing(spark, x, "").collect())) for x in (d, d.repartition(5)))
    assert one == two and len(one) > 50


def plain_recall(rows, got, k=5, every=50):
    """Share of each query's k nearest that were found, by score, so equal vectors count alike."""
    good = {i: np.array(v, dtype=float) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids, x = np.array(list(good)), np.stack(list(good.values()))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = wanted = 0
    for q in (i for i in good if i % every == 0):
        at = int(np.flatnonzero(ids == q)[0])
        sims = x @ x[at]
        sims[at] = -9
        want = np.sort(sims)[::-1][:k]
        found = np.sort([s for s in got.get(q, [])])[::-1]
        assert len(found) == min(k, len(ids) - 1)
        hits += int((np.abs(found - want) < 1e-9).sum()) if len(found) == len(want) else 0
        wanted += len(want)
    return hits / wanted


@pytest.mark.skipif(not os.path.isdir("/root/testdata"), reason="no test tables")
@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_tables(spark, sf):
    d = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    got = defaultdict(list)
    for x in additive.nearest(d).collect():
        got[x["query_id"]].append(x["score"])
    assert plain_recall([(r["vec_id"], r["embedding"]) for r in d.collect()], got) >= 0.95


def test_recall_among_close_neighbours(spark):
    r = np.random.default_rng(8)
    centres = r.normal(size=(6, 32))
    rows = [(i, [float(x) for x in centres[i % 6] + r.normal(size=32) * 0.3]) for i in range(6000)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = defaultdict(list)
    for x in additive.nearest(d, group_bytes=10_000).collect():  # several groups of queries
        got[x["query_id"]].append(x["score"])
    assert plain_recall(rows, got) >= 0.9


@pytest.mark.parametrize("where", ["query", "candidates", "sample"])
@pytest.mark.parametrize("size", [1e-320, 1e-200, 1e200, 1.7e308])
def test_numbers_of_any_size(spark, size, where):
    r = np.random.default_rng(4)
    x = r.integers(-1000, 1001, size=(300, 8)) / 1000.0
    x[np.abs(x).max(1) == 0] = 1.0
    with np.errstate(under="ignore"):
        grow = np.ones(len(x))
        grow[{"query": [0, 50], "candidates": slice(1, None, 7), "sample": [13]}[where]] = size
        big = x * grow[:, None]
    big[np.abs(big).max(1) == 0] = 5e-324
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(big)]
    got = defaultdict(list)
    for q in additive.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), shard=64).collect():
        got[q["query_id"]].append((q["rank"], q["vec_id"], q["score"]))
    exact = [[Fraction(v) for v in row] for _, row in rows]  # no over- or underflow here
    for q in range(0, 300, 50):
        top = max(map(abs, exact[q]))
        mine = np.array([float(v / top) for v in exact[q]])
        cosine = []
        for i, row in enumerate(exact):
            him = np.array([float(v / max(map(abs, row))) for v in row])
            cosine.append(-9.0 if i == q else float(mine @ him / np.sqrt((mine @ mine) * (him @ him))))
        want = sorted(range(300), key=lambda i: (-round(cosine[i], 9), i))[:5]
        found = sorted(got[q])
        assert len(found) == 5 and np.allclose([s for *_, s in found], [cosine[i] for i in want], atol=1e-9)


def test_long_vectors_many_shards_in_a_batch(spark):
    r = np.random.default_rng(6)
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(r.normal(size=(220, 3000)))]
    got = defaultdict(list)
    for q in additive.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1), shard=16).collect():
        got[q["query_id"]].append(q["score"])
    assert plain_recall(rows, got) >= 0.9


def test_a_repeated_id_counts_once(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 0.2]), (2, [0.5, 0.1]), (2, [0.5, 0.1])]
    want = [(0, 1, 1), (0, 2, 2)]  # least vectors: 0 has (0, 1), 1 has (1, 0.2)
    for n in (1, 4):
        d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(n)
        assert sorted((x["query_id"], x["rank"], x["vec_id"]) for x in additive.nearest(d).collect()) in (want, [(0, 1, 2), (0, 2, 1)])
        got = {x["vec_id"]: x["score"] for x in additive.nearest(d).collect()}
        assert math.isclose(got[1], 0.2 / math.hypot(1, 0.2)) and math.isclose(got[2], 0.1 / math.hypot(0.5, 0.1))


def test_long_words_have_a_heap():
    coder, r = sp_bpe.Agenda(tokenizer_file("piece_bpe_32k.model")), random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = ["".join(r.choice(letters) for _ in range(300_000)), "".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(20_000)), "กขคงจฉช" * 3000, "ab " * 500 + "internationalization" * 200 + " x" * 400, "🙂é" * 700]
    began = time.time()
    ids, at, _ = coder.encode(pa.array(texts))
    assert time.time() - began < 20
    for text, part in zip(texts, np.split(ids, at[1:-1]), strict=True):
        assert part.tolist() == coder.library.encode(text, add_eos=True)
    words = ["▁" + "".join(r.choice("etaoin shr") for _ in range(r.randint(1, 400))).replace(" ", "") for _ in range(60)]
    assert [coder.work_off(w).tolist() for w in words] == [x.tolist() for x in np.split(*(lambda f, n: (f, np.cumsum(n)[:-1]))(*coder._together(words)))]


def test_a_vocabulary_that_spans_words_and_the_librarys_ids():
    coder = sp_bpe.Agenda(tokenizer_file("piece_bpe_32k.model"))
    texts = ["one text as a whole", "", "a  b " * 90]
    coder.inner = True
    ids, at, _ = coder.encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, at[1:-1])] == [coder.library.encode(t, add_eos=True) for t in texts]
    wrong = [[1, 2], [coder.end], [3]]
    assert coder.checked(texts, wrong, [True] * 3) == ([coder.library.encode(t, add_eos=True) for t in texts], [False, True, False])


def test_the_agenda_gives_the_ids():
    """A broken agenda shows in its ids and in `agrees`; the library's stand in for its lists only."""
    coder = sp_bpe.Agenda(tokenizer_file("piece_bpe_32k.model"))
    r = random.Random(1)
    texts = ["".join(r.choice("etaoinshrdlu") for _ in range(20)) for _ in range(30)] + ["of"]
    right = [coder.library.encode(t, add_eos=True) for t in texts]
    coder.order = coder.order.max() - coder.order  # worst merges first
    ids, at, doubt = coder.encode(pa.array(texts))
    lists = [x.tolist() for x in np.split(ids, at[1:-1])]
    assert sum(a != b for a, b in zip(lists, right, strict=True)) > 20
    assert all(d for a, b, d in zip(lists, right, doubt, strict=True) if a != b) and not coder.known  # no word in doubt is remembered
    got, same = coder.checked(texts, lists, doubt.tolist())
    assert got == right and same == [a == b for a, b in zip(lists, right, strict=True)]
    kept, same = coder.checked(texts, right, [True] * len(texts))
    assert all(same) and all(a is b for a, b in zip(kept, right, strict=True))


def test_long_words_score_as_their_middle():
    r = random.Random(9)
    kern = toxicity.Kernel(["worthless", "idiot", "scum"])
    spaced = "wxoxrxtxhxlxexsxs"
    assert kern.values([spaced])[0, 0] > 0.3
    for before in (0, 3, 10, 40, 130, 180, 190, 200, 1000):
        word = "".join(r.choice("abcdfg") for _ in range(before)) + spaced + "".join(r.choice("abcdfg") for _ in range(r.choice([0, 7, 300])))
        assert math.isclose(kern.values([word])[0, 0], kern.values([spaced])[0, 0], rel_tol=1e-5), before
    words = ["".join(r.choice("worthlesidcumx") for _ in range(r.choice([5, 30, 150, 193, 260, 700]))) for _ in range(40)]
    got = kern.values(words)
    for w, row in zip(words, got, strict=True):  # the recurrence over the whole word
        codes, n = toxicity.coded([w])
        for j, mark in enumerate(kern.codes):
            whole = float(toxicity.kernel(codes, n, mark, *kern.parts[j])[0] / kern.own[j])
            assert math.isclose(row[j], whole if whole >= toxicity.FLOOR else 0, rel_tol=1e-4, abs_tol=1e-5)
    began = time.time()
    assert kern.values(["ab" * 100_000 + "idxiot" + "ab" * 50_000])[0, 1] > 0.3 and time.time() - began < 20


def test_kernel_values_equal_brute_force():
    r = random.Random(11)
    marks = ["idiot", "scum", "stupid", "banana", "abcdefgh", "ééàé"]
    words = ["".join(r.choice("idotscumpbanegéà") for _ in range(r.randint(1, 14))) for _ in range(300)]
    words += ["ixdxixoxt", "sxcxum", "bxaxnxaxnxa", "stuupid", "idiotidiot", "xabcdxefgh", "", "a"]
    kern = toxicity.Kernel(marks)
    got = kern.values(words)
    for i, w in enumerate(words):
        for j, m in enumerate(marks):
            want = plain_kernel(w, m, 4, toxicity.DECAY) / plain_kernel(m, m, 4, toxicity.DECAY)
            assert math.isclose(got[i, j], want if want >= toxicity.FLOOR else 0, rel_tol=1e-4, abs_tol=1e-5) or abs(want - toxicity.FLOOR) < 1e-5, (w, m)


def test_insults_with_letters_between_any_two():
    texts = toxic_texts(600, 4)
    model = toxicity.fit([t for t, _ in texts], np.array([y for _, y in texts]))
    score = lambda *ts: model.score(toxicity.text_features(pa.array(ts, pa.string()), model.kernel))
    clean = " ".join(vocabulary(4)[:30])
    assert (score(*(f"{clean} {w} {clean}" for w in ("ixdxixoxt", "idxiot", "idxyziot", "sczumbag", "sczumbazg", "worxthless", "wworthleess"))) >= toxicity.THRESHOLD).all()
    assert (score(clean, *(t for t, y in toxic_texts(300, 4) if not y)) < toxicity.THRESHOLD).mean() > 0.97


def test_the_machine_against_plain_descent():
    r = np.random.default_rng(2)
    x = r.normal(size=(120, 3))
    y = (x @ [1.0, -2.0, 0.5] + 0.3 + r.normal(size=120) * 0.5 > 0.8).astype(int)
    sign, weight = np.where(y > 0, 1, -1), np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y <= 0).sum()) * len(y)

    def loss(w):
        return 0.5 * (w[:3] ** 2).sum() / len(y) + 20 / len(y) * (weight * np.maximum(0, 1 - sign * (x @ w[:3] + w[3])) ** 2).sum()

    weights, bias = toxicity.train(x, y)
    best, step = np.zeros(4), 1.0  # coordinate search
    while step > 1e-7:
        moves = [best + step * s * np.eye(4)[i] for i in range(4) for s in (1, -1)]
        new = min(moves, key=loss)
        best, step = (new, step) if loss(new) < loss(best) else (best, step / 2)
    assert math.isclose(loss(np.r_[weights, bias]), loss(best), rel_tol=1e-3)


def test_a_group_of_one_passage_is_no_landmark():
    passage = "one two qqzzqq three four".split()
    toxic = [["w%d%s" % (k, c) for c in "abcdef"] + passage + [f"a{k}", "wretch", f"b{k}"] for k in range(40)]
    got = toxicity.landmarks([set(t) for t in toxic], [{"clean"}] * 300, contexts=toxicity.contexts_of(toxic))
    assert got and all(m in "wretch" for m in got)


def plain_bayes(rows):
    """rows: (doc_id, text, lang) -> {doc_id: (lang, score)} by the definition, text by text."""
    counts = defaultdict(lambda: np.zeros(langid.DIMS))
    for i, t, lang in rows:
        if lang is not None and t and zlib.crc32(str(i).encode()) % 4 != 2:
            counts[lang] += langid.profile(t, langid.DIMS)
    langs = sorted(counts)
    logp = [np.log(counts[x] + langid.ALPHA) - np.log(counts[x].sum() + langid.ALPHA * langid.DIMS) for x in langs]
    out = {}
    for i, t, _ in rows:
        if not langs or t is None or not any(c.isalpha() for c in t):
            out[i] = ("und", 0.0)
            continue
        joint = np.array([langid.profile(t, langid.DIMS) @ p for p in logp])
        out[i] = (langs[int(joint.argmax())], 1 / np.exp(joint - joint.max()).sum())
    return out


@pytest.mark.parametrize("cells", [1 << 21, 300])
def test_language_against_plain_bayes(spark, cells, monkeypatch):
    monkeypatch.setattr(langid, "CELLS", cells)  # 300: many blocks of languages, hence many passes
    monkeypatch.setattr(langid, "SLICE", 500)
    monkeypatch.setattr(langid, "HELD", 400)
    monkeypatch.setattr(langid, "STRETCH", 300)
    r = random.Random(6)
    words = {lang: ["".join(r.choice(a) for _ in range(r.randint(2, 6))) for _ in range(40)] for lang, a in (("de", "abcdeß"), ("en", "cdefgh"), ("fr", "efghéè"), ("z\U0001f642", "хцчш"), ("same1", "xyz"))}
    rows = [(k, " ".join(r.choice(words[lang]) for _ in range(r.randint(1, 120))) + r.choice(["", " 12!", "\n\n"]), lang) for k in range(150) for lang in [r.choice(list(words))]]
    rows += [(200, None, "en"), (201, "", "fr"), (202, "12 34 !", "empty"), (203, "cde fgh", None), (204, "\U0001f642", None), (205, rows[0][1], rows[0][2])]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {x["doc_id"]: (x["lang_pred"], x["score"]) for x in langid.language_id(d).collect()}
    want = plain_bayes(rows)
    assert got.keys() == want.keys()
    for i, (lang, score) in want.items():
        assert math.isclose(got[i][1], score, rel_tol=1e-6, abs_tol=1e-9) and (got[i][0] == lang or math.isclose(score, 0.5, rel_tol=1e-6)), i
    assert (len(langid.fit(d.select("text", "lang"))) > 1) == (cells == 300)


def test_batch_profiles_are_those_of_each_text(monkeypatch):
    r = random.Random(9)
    texts = ["".join(r.choice("abé ß1!\n🙂漢") for _ in range(r.randint(0, 60))) for _ in range(200)] + [None, "", " ", "  a", "a" * 2000]
    monkeypatch.setattr(langid, "STRETCH", 500)
    row, bucket, n = langid.profiles(texts)
    for i, t in enumerate(texts):
        want = langid.profile(t or "", langid.DIMS)
        assert dict(zip(bucket[row == i].tolist(), n[row == i].tolist(), strict=True)) == {k: want[k] for k in np.flatnonzero(want).tolist()}, repr(t)


def test_landing_with_one_large_document():
    r = random.Random(1)
    size = [float(r.randint(1, 400)) for _ in range(500)] + [20020.0]
    pi = [float(r.random() < 0.9) for _ in range(500)] + [0.4]
    wanted = (0.9 * sum(size[:500]) + 0.4 * 20020, 450.4)
    got = cube.landing(pi, size, wanted)
    assert set(got) <= {0.0, 1.0} and abs(sum(p * x for p, x in zip(got, size, strict=True)) - wanted[0]) <= 2


@pytest.mark.skipif(not os.path.isdir("/root/testdata"), reason="no test tables")
def test_sources_come_near_their_targets(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = cube.mix(d).groupBy("source").agg({"taken": "sum", "target": "max", "doc_id": "count"}).collect()
    far = {x["source"]: abs(x["sum(taken)"] / x["max(target)"] - 1) for x in got if x["count(doc_id)"] >= 100 and x["max(target)"]}
    assert far and max(far.values()) < 0.01, far


def test_planes_are_compressed_and_open_block_by_block():
    r = np.random.default_rng(3)
    ids = np.minimum(r.zipf(1.3, 400_000), 50_000).astype(np.int64)
    raw = wavelet.WaveletMatrix.build(ids, 16).dump()
    assert len(raw) < 1.6 * len(ids)  # plain 16-bit ids take 2 bytes each
    m = wavelet.WaveletMatrix.load(b"head" + raw, 4)
    for i in (0, 1, 131_071, 131_072, 262_143, 399_999):
        assert m.access(i) == ids[i]
    for t in (1, 2, 77, 50_000):
        assert m.count(t) == (ids == t).sum() and m.count(t, 200_001) == (ids[:200_001] == t).sum()
        if (ids == t).any():
            assert m.locate(t, 0) == np.flatnonzero(ids == t)[0] and m.locate(t, int((ids == t).sum()) - 1) == np.flatnonzero(ids == t)[-1]
    assert (m.decode() == ids).all()
    one = wavelet.Plane(wavelet.BLOCK + 5, *(lambda e, b: (e, memoryview(b)))(*wavelet.Plane.packed(r.integers(0, 256, wavelet.BLOCK + 5).astype(np.uint8))))
    assert len(one.whole()) == wavelet.BLOCK + 5  # bytes that gain nothing stay as they are


def test_texts_without_frequent_lines(spark):
    rows = [(k, f"own {k}\nFrom the desk of {k % 10}\n\nlast", "h") for k in range(12)] + [(50, "From the desk of 7", "h"), (51, "From the desk of 7", "other"), (52, None, "h"), (0, "own 0\nFrom the desk of 0\n\nlast", "h")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["text"], r["n_lines_removed"]) for r in quality.without_frequent_lines(d).collect()}
    assert got[0] == ("own 0\n", 2) and got[50] == ("", 1) and got[51] == ("From the desk of 7", 0) and got[52] == ("", 0)
    assert len(got) == 15 and all(got[k][0].startswith(f"own {k}") for k in range(12))
    kept = {r["doc_id"]: r["text"] for r in quality.without_frequent_lines(d, max_docs=99).collect()}
    assert all(kept[i] == (t or "") for i, t, _ in rows)


@pytest.fixture(scope="module")
def long_rows():
    """One text beyond every slice, stretch and Arrow batch, one word beyond a heap's bound, and short ones."""
    r, v = random.Random(21), [w for w in vocabulary(21, 3000) if len(w) > 1]
    long = "\n".join(say(r, v, 12) for _ in range(150_000))
    assert len(long) > 9 << 20
    return [(1, long), (2, "x" * 300_000), (3, long[:4000]), (4, "a few words here"), (5, None), (6, "")]


@pytest.mark.parametrize("op", ["op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9"])
def test_texts_beyond_slices_and_batches(spark, long_rows, op):
    d = spark.createDataFrame([(i, t, "en", "s", 0, "t") for i, t in long_rows], "doc_id long, text string, lang string, source string, n_chars long, tag string").repartition(2)
    words = {i: len(brute.words(t)) for i, t in long_rows}
    labels = spark.createDataFrame([(i, int(i == 4)) for i, _ in long_rows], "doc_id long, toxic int")
    run = {
        "op1": lambda: {r["doc_id"]: r["lang_pred"] for r in langid.language_id(d).collect()},
        "op2": lambda: {r["doc_id"]: r["n_words"] for r in superkmer.substring_dedup(d).collect()},
        "op3": lambda: {r["doc_id"]: r["n_tokens"] - 1 for r in ppm.lm_scores(d).collect()},
        "op4": lambda: {r["doc_id"]: r["size"] for r in cube.mixed_sizes(d).collect()},
        "op5": lambda: {r["doc_id"]: r["n_words"] for r in quality.quality_rules(d).collect()},
        "op6": lambda: {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(d, labels).collect()},
        "op7": lambda: {r["doc_id"]: r["ids_crc32"] for r in wavelet.token_files(d, tokenizer_file("byte_bpe_50k.json")).collect()},
        "op8": lambda: {r["doc_id"]: r["n_shingles"] for r in jaccard.jaccard_join(d).collect()},
        "op9": lambda: {r["doc_id"]: (r["n_tokens"], r["agrees"]) for r in sp_bpe.sentencepiece_digest(d, tokenizer_file("piece_bpe_32k.model")).collect()},
    }
    got = run[op]()
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    if op in ("op2", "op3", "op4", "op5"):
        assert got == words
    elif op == "op1":
        assert got[1] == "en" and got[5] == got[6] == "und"
    elif op == "op7":
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
        for i, text in long_rows:
            ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
            assert got[i] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    elif op == "op8":
        assert got == {i: len(brute.shingles(t)) for i, t in long_rows}
    elif op == "op9":
        lib = sp_bpe.Agenda(tokenizer_file("piece_bpe_32k.model")).library
        assert got == {i: (len(lib.encode(t or "", add_eos=True)), True) for i, t in long_rows}


DIRTY = "doc_id long, text string, lang string, source string, n_chars long, tag string, _copies int, node long"


@pytest.fixture
def tables(spark, tmp_path):
    """A folder of tables for the pipeline: dirty documents with columns whose names the stages use, and labels."""

    def make(rows, labels):
        spark.createDataFrame([(*r, "t", 3, 9) for r in rows], DIRTY).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
        return str(tmp_path)

    return make


def test_pipeline_of_dirty_documents(spark, tables):
    import corpus_pipeline as p

    r, v = random.Random(31), vocabulary(31, 300)
    base = [r.choice(v) for _ in range(80)]
    rows = [(k, say(r, v, r.randint(1, 60)), r.choice(["en", None]), r.choice(["a", "b", None]), r.choice([1, None])) for k in range(60)]
    rows += [(100, " ".join(base), "en", "a", 1), (101, " ".join(base), "en", "b", 1), (102, " ".join([*base[:-1], "other"]), None, None, None), (103, None, None, None, None), (104, "", "en", "a", 0), (105, " \n ", "fr", "b", 3), (None, "no id", "en", "a", 1)]
    rows += [rows[0], rows[60], (7, "a second text of one id " + say(r, v, 20), "en", "a", 5), (200, say(r, v, 5000), "en", "c", 9)]
    sf = tables(rows, [(k, 0, 1) for k in range(20)] + [(None, 1, 1), (3, None, 1)])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    outs = []
    for k, (_, stage) in enumerate(p.STAGES):
        docs = stage(spark, docs, sf)
        outs.append([x.asDict() for x in docs.collect()])
        if k < 4:
            assert docs.columns == list(p.COLUMNS)
            docs = spark.createDataFrame([tuple(x[c] for c in p.COLUMNS) for x in outs[-1]], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(x["doc_id"] for x in outs[0]) == sorted(x[0] for x in rows if x[0] is not None)  # nothing is toxic without toxic labels
    kept = [(x["doc_id"], x["text"]) for x in outs[1]]
    assert (100, " ".join(base)) in kept and not {101, 102} & {i for i, _ in kept} and {103, 104, 105} <= {i for i, _ in kept}
    assert len([1 for i, _ in kept if i == 7]) == 2 and len([1 for i, _ in kept if i == 0]) == 1
    assert {x["doc_id"] for x in outs[2]} >= {103, 104, 105, 100}
    assert all(x["agrees"] for x in outs[4]) and len(outs[4]) == len(outs[3])


def test_pipeline_of_nothing(spark, tables):
    import corpus_pipeline as p

    assert p.run(spark, tables([], [])).count() == 0


def test_remembered_words(monkeypatch):
    monkeypatch.setattr(sp_bpe, "REMEMBERED", 7)
    coder, r = sp_bpe.Agenda(tokenizer_file("piece_bpe_32k.model")), random.Random(2)
    v = vocabulary(2, 30) + ["y" * 300, "🙂"]
    for _ in range(5):
        texts = [say(r, v, r.randint(0, 40)) for _ in range(9)]
        ids, at, _ = coder.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, at[1:-1])] == [coder.library.encode(t, add_eos=True) for t in texts]
    assert len(coder.known) == 7
