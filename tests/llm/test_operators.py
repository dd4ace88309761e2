import hashlib
import json
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadloom.llm import additive, cube, jaccard, langid, ppm, quality, superkmer, sp_bpe, toxicity, wavelet
from threadloom.llm.common import word_hashes, word_spans
from threadloom.llm.components import components
from threadloom.llm.queries import queries, tokenizer_file

from . import brute

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
# columns whose names the operators use inside
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tag string, node string, runs int, size string, text_key string, bucket int, words int, lines int, pi double, block int"


def vocabulary(seed, n=400):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(1, 9))) for _ in range(n)]


def made(seed=1):
    """Texts with nulls, empties, one very long, repeated rows, copies near and exact, shared passages, odd white space and letters."""
    r, v = random.Random(seed), vocabulary(seed)
    say = lambda n: " ".join(r.choice(v) for _ in range(n))
    passage, base = say(60), say(200).split()
    texts = [None, "", "   \n\t ", "one", "a b c d e", "A B c d E", say(3000), passage, say(30) + " " + passage + "\n" + say(20), passage + " " + passage, say(13), say(12)]
    texts += [" ".join(base), " ".join(base).upper(), "  ".join(base), "\n".join(base)]
    for _ in range(30):  # near copies at all distances
        w = list(base)
        for _ in range(r.randint(0, 12)):
            w[r.randrange(len(w))] = r.choice(v)
        texts.append(" ".join(w))
    texts += ["line of boilerplate here\n" + say(r.randint(1, 80)) for _ in range(14)] + [say(40) + "\nline of boilerplate HERE\n" + say(r.randint(1, 90)) for _ in range(3)]
    texts += ["rep rep rep rep " * 20, "x\nx\nx\ny", "ñandú no break ß 漢字 🙂 \x1c sep", "<|endoftext|> #*$ 100% &|<>", "w " * 60 + "\n" + "w " * 60, "\u0085 next"]
    texts += [say(r.randint(1, 150)) for _ in range(25)]
    ids = list(range(0, 3 * len(texts), 3))
    r.shuffle(ids)
    rows = [(i, t, r.choice(["en", "fr", None]), r.choice(["s1", "s2", "s3", None]), 5) for i, t in zip(ids, texts, strict=True)]
    return rows + rows[10:14]  # repeated rows


def frame(spark, rows):
    more = [(None, "no id", "en", "s1", 1)]
    return spark.createDataFrame([(*x, "t", "n", 1, "z", "k", 2, 3, 4, 0.5, 6) for x in [*rows, *more]], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def rows():
    return made()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# --- common -----------------------------------------------------------------------------------------------------------


def test_word_spans_and_hashes(rows):
    texts = [t for _, t, *_ in rows]
    data = np.frombuffer("".join(t or "" for t in texts).encode(), dtype=np.uint8)
    offsets = np.r_[0, np.cumsum([len((t or "").encode()) for t in texts])]
    starts, ends, at = word_spans(data, offsets)
    assert [[bytes(data[a:z]).decode() for a, z in zip(starts[lo:hi], ends[lo:hi], strict=True)] for lo, hi in zip(at, at[1:], strict=False)] == [brute.words(t) for t in texts]
    small, large = word_hashes(data, starts, ends, most=64), word_hashes(data, starts, ends)
    assert (small == large).all()
    by = defaultdict(set)
    for a, z, h in zip(starts, ends, large, strict=True):
        by[bytes(data[a:z])].add(int(h))
    assert all(len(x) == 1 for x in by.values()) and len({next(iter(x)) for x in by.values()}) == len(by)


def test_components(spark, tmp_path):
    r = random.Random(5)
    edges = [(r.randint(1, 300), r.randint(1, 300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(1, 50)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path)).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long"), str(tmp_path / "x")).count() == 0


# --- 1 ----------------------------------------------------------------------------------------------------------------


def test_language_cases(spark, docs, rows, nothing):
    got = langid.language_id(docs).collect()
    assert len(got) == len(rows)
    text = {i: t for i, t, *_ in rows}
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, text[r["doc_id"]] or "")))
    assert langid.language_id(nothing).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.language_id(unlabelled).collect()} == {"und"}


def test_ngrams_do_not_depend_on_stretches(monkeypatch):
    text = "Aa  b-c ñandú\n\n漢字 🙂 " * 50
    whole = langid.profile(text, 1 << 12)
    monkeypatch.setattr(langid, "STRETCH", 7)
    assert (langid.profile(text, 1 << 12) == whole).all()


@needs_tables
def test_language_held_out(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries()["op1_language_id"](spark, SF).join(d.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang_pred = lang").count() >= 0.97 * got.count()


# --- 2 ----------------------------------------------------------------------------------------------------------------


def test_substring_dedup(docs, rows, nothing):
    want = brute.substring_dedup([(i, t) for i, t, *_ in rows])
    assert sorted(map(tuple, superkmer.substring_dedup(docs).collect())) == want
    assert sum(x[2] for x in want) > 1000
    assert superkmer.substring_dedup(nothing).count() == 0


def test_substring_dedup_of_small_slices(docs, rows, monkeypatch):
    monkeypatch.setattr(superkmer, "SLICE", 500)
    assert sorted(map(tuple, superkmer.substring_dedup(docs, k=5).collect())) == brute.substring_dedup([(i, t) for i, t, *_ in rows], 5)


def test_one_id_with_two_texts(spark):
    a = " ".join(vocabulary(3)[:40])
    rows = [(1, a), (2, a + " more"), (2, "other words"), (3, a)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, superkmer.substring_dedup(d).collect())) == brute.substring_dedup(rows)


def test_minimisers_and_hash_ties():
    h = np.random.default_rng(0).integers(0, 1 << 63, 100).astype(np.uint64)
    got = superkmer.minimisers(h, 13, 1)
    assert (got == np.array([h[i : i + 13].min() for i in range(88)])).all()
    # a bucket whose windows share one hash is still told apart by the words
    text = " ".join(vocabulary(4)[:60])
    t = pa.table({"doc_id": [1, 2, 3], "tag": pa.array([0, 0, 0], pa.int32()), "text": [text, text.replace(" ", "  "), text[::-1]]}).to_batches()[0]
    blobs = [b for _, b in superkmer.super_kmers(t, 1)]
    real = superkmer.mix
    superkmer.mix = lambda x: np.zeros_like(x)
    try:
        doc, _, start, n = superkmer.windows_seen_before(blobs)
    finally:
        superkmer.mix = real
    assert set(doc.tolist()) == {2} and n.sum() == 48


def test_stage_keeps_what_is_not_repeated(docs, rows):
    got = superkmer.without_repeats(docs.filter("doc_id IS NOT NULL"))
    assert got.columns == docs.columns
    want = {(i, s) for i, n, gone, s in brute.substring_dedup([(i, t) for i, t, *_ in rows]) if not n or gone < n}
    sha = lambda t: hashlib.sha256(" ".join(brute.words(t)).encode()).hexdigest()
    assert {(r["doc_id"], sha(r["text"])) for r in got.collect()} == want
    text = {i: t for i, t, *_ in rows}
    untouched = {i for i, _, gone, _ in brute.substring_dedup([(i, t) for i, t, *_ in rows]) if not gone}
    assert all(r["text"] == text[r["doc_id"]] for r in got.collect() if r["doc_id"] in untouched)


# --- 3 ----------------------------------------------------------------------------------------------------------------


def test_base_scores(docs, rows, nothing):
    got = ppm.lm_scores(docs).collect()
    assert len(got) == len(rows)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    count = Counter()
    for i, t, *_ in rows:
        if not held(i):
            count.update([*brute.words(brute.lower(t)), None])
    n, v, text = sum(count.values()), len(count), {i: t for i, t, *_ in rows}
    for r in got:
        tokens = [*brute.words(brute.lower(text[r["doc_id"]])), None]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(r["doc_id"]), len(tokens), sum(count[x] > 0 for x in tokens), n)
        assert math.isclose(r["base_score"], sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens), rel_tol=1e-9)
        assert r["score"] < 0
    assert ppm.lm_scores(nothing).count() == 0


def levels_of(texts, order):
    k, _ = ppm.gram_keys(pa.array(texts, pa.string()))
    k, c = np.unique(k, return_counts=True)
    return [ppm._merged([k & ppm._mask(n + 1)], [c]) for n in range(order + 1)]


def plain_ppm(train, order):
    """Method D with exclusion by the definition, over lists of symbols."""
    counts = defaultdict(Counter)
    for t in train:
        s = [ppm.START] * order + list(brute.lower(t).encode()) + [ppm.END]
        for i in range(order, len(s)):
            for n in range(order + 1):
                counts[tuple(s[i - n : i])][s[i]] += 1

    def cost(context, symbol):
        gone, total = set(), 0.0
        for n in range(order, -1, -1):
            c = counts.get(tuple(context[len(context) - n :]))
            if not c:
                continue
            left = {s: k for s, k in c.items() if s not in gone}
            if not left:
                continue
            whole = sum(left.values())
            if symbol in left:
                return total + math.log10((2 * left[symbol] - 1) / (2 * whole))
            total += math.log10(len(left) / (2 * whole))
            gone |= set(left)
        return total - math.log10(ppm.SYMBOLS - len(gone))

    def score(t):
        s = [ppm.START] * order + list(brute.lower(t).encode()) + [ppm.END]
        return sum(cost(s[:i], s[i]) for i in range(order, len(s)))

    return score


def test_partial_matching_by_definition():
    train = ["abracadabra", "abra cadabra", "Banana bandana", "", "zz"]
    model, score = ppm.Model(levels_of(train, ppm.ORDER)), plain_ppm(train, ppm.ORDER)
    for t in ("abracadabra", "cabbage", "", "ünseen Q", "bandanabra"):
        keys, _ = ppm.gram_keys(pa.array([t], pa.string()))
        assert math.isclose(model.cost(keys).sum(), score(t), rel_tol=1e-9)
    for key in ppm.gram_keys(pa.array(["abrax", "ba"], pa.string()))[0].tolist():
        assert math.isclose((10 ** model.cost((key >> 9 << 9) + np.arange(257))).sum(), 1.0, rel_tol=1e-9)


@pytest.mark.parametrize("room", [0, 300, 1 << 20])
def test_scores_are_those_of_the_whole_trie(rows, docs, room, monkeypatch):
    """However few costs are broadcast, and however many buckets there are: no context is dropped."""
    monkeypatch.setattr(ppm, "BUCKET_BYTES", 2000)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    model = ppm.Model(levels_of([t for i, t, *_ in rows if not held(i) and t is not None], ppm.ORDER))
    want = {i: model.cost(ppm.gram_keys(pa.array([t], pa.string()))[0]).sum() for i, t, *_ in rows}
    got = ppm.lm_scores(docs, room).collect()
    assert len(got) == len(rows)
    for r in got:
        assert math.isclose(r["score"], want[r["doc_id"]], rel_tol=1e-9)


def test_untrained_model_is_uniform():
    model = ppm.Model([(np.zeros(0, dtype=np.int64),) * 2])
    assert math.isclose(model.cost(ppm.gram_keys(pa.array(["abc"]))[0]).sum(), -4 * math.log10(257))


# --- 4 ----------------------------------------------------------------------------------------------------------------


def plain_targets(sizes):
    """sizes by source -> targets by resharing until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in above}


def test_mixing(spark, docs, rows, nothing):
    got = cube.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(brute.words(t))
    want = plain_targets(dict(sizes))
    taken = Counter()
    for r in got:
        assert math.isclose(r["target"], want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.05 * want[s] + 5 for s in want)
    assert sorted(map(tuple, cube.mixed_sizes(docs.repartition(2)).collect())) == sorted(map(tuple, cube.mixed_sizes(docs).collect()))
    assert cube.mix(nothing).count() == 0


def test_targets_stop_at_three_times(spark):
    d = spark.createDataFrame([(i, "w " * n, s) for i, (n, s) in enumerate([(1, "a"), (500, "b"), (2, "c"), (300, "d"), (0, "e")])], "doc_id long, text string, source string")
    want = plain_targets({"a": 1, "b": 500, "c": 2, "d": 300, "e": 0})
    got = {r["source"]: r for r in cube.mix(d).collect()}
    assert {s: round(r["target"], 6) for s, r in got.items()} == {s: round(x, 6) for s, x in want.items()} and got["a"]["taken"] == 3 and got["e"]["taken"] == 0


def test_flight_keeps_the_totals():
    r = random.Random(1)
    for n in (0, 1, 2, 3, 50, 500):
        size, pi = [float(r.randint(0, 900)) for _ in range(n)], [r.random() for _ in range(n)]
        out = cube.flight(pi, size, random.Random(n))
        assert sum(0 < x < 1 for x in out) <= 2
        assert math.isclose(sum(out), sum(pi), abs_tol=1e-6) and math.isclose(sum(a * b for a, b in zip(out, size, strict=True)), sum(a * b for a, b in zip(pi, size, strict=True)), abs_tol=1e-3)


def test_levels_of_blocks(spark, tmp_path):
    r = random.Random(3)
    units = spark.createDataFrame([(i, 0, 1, "s", r.randint(1, 99), 0.3, 500) for i in range(500)], "doc_id long, text_key long, copy int, source string, size long, pi double, n_docs long")
    got = cube.sample(units, str(tmp_path), block=16).collect()
    assert len(got) == 500 and {x["pi"] for x in got} == {0.0, 1.0}
    want = 0.3 * sum(x["size"] for x in got)
    assert abs(sum(x["size"] * x["pi"] for x in got) - want) < 60


def test_inclusion_is_fair():
    size = [10.0, 20.0, 30.0, 15.0, 25.0, 5.0]
    times = np.zeros(6)
    for k in range(3000):
        times += np.array(cube.flight([0.4] * 6, size, random.Random(k)))
    assert np.abs(times / 3000 - 0.4).max() < 0.05


# --- 5 ----------------------------------------------------------------------------------------------------------------


def test_quality(docs, rows, nothing):
    want = brute.quality([(i, t, s) for i, t, _, s, _ in rows], 3)
    assert sorted(map(tuple, quality.quality_rules(docs, max_docs=3).collect())) == want
    assert quality.quality_rules(nothing).count() == 0


def test_depleted_documents_go(spark):
    v = vocabulary(8)
    own = lambda k: " ".join(v[(k * 61 + j * 7) % 400] for j in range(60))
    line = " ".join(v[:100])
    rows = [(k, own(k) + "\n" + (line if k % 2 else ""), "h" if k < 30 else "other") for k in range(32)]
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == {k: not (k % 2 and k < 30) for k in range(32)}


# --- 6 ----------------------------------------------------------------------------------------------------------------


def plain_kernel(s, t, p, lam):
    from itertools import combinations

    def spans(x):
        found = {}
        for c in combinations(range(len(x)), p):
            u = "".join(x[i] for i in c)
            found[u] = min(found.get(u, 99), c[-1] - c[0] + 1)
        return found

    a, b = spans(s), spans(t)
    return sum(lam ** (a[u] + b[u]) for u in a if u in b)


@pytest.mark.parametrize(("a", "b"), [("idiot", "idiot"), ("idxiot", "idiot"), ("abc", "abcd"), ("banana", "bandana"), ("xyz", "idiot")])
def test_kernel_by_definition(a, b):
    w, n = toxicity.coded([a])
    m = np.array([ord(c) for c in b], dtype=np.uint16)
    for p in (2, 3, 4):
        if p <= len(b):
            assert math.isclose(float(toxicity.kernel(w, n, m, *toxicity.subsequences(b, p), 0.8)[0]), plain_kernel(a, b, p, 0.8), rel_tol=1e-4, abs_tol=1e-6)


def toxic_texts(n, seed):
    r, v = random.Random(seed), [w for w in vocabulary(seed) if len(w) > 1]
    bad = ["idiot", "scumbag", "worthless"]
    out = []
    for k in range(n):
        w = [r.choice(v) for _ in range(r.randint(5, 60))]
        if k % 3 == 0:
            w[r.randrange(len(w))] = r.choice(bad)
        out.append((" ".join(w), int(k % 3 == 0)))
    return out


def test_gapped_insults():
    texts = toxic_texts(300, 4)
    model = toxicity.fit([t for t, _ in texts], np.array([y for _, y in texts]))
    assert any("idiot" in m or m in "idiot" for m in model.kernel.marks)
    score = lambda *ts: model.score(toxicity.text_features(pa.array(ts, pa.string()), model.kernel))
    clean = " ".join(vocabulary(4)[:30])
    assert (score(f"{clean} idiot", f"{clean} i d i o t {clean}", f"{clean} i.d.i.o.t!", f"{clean} IDIOT", f"{clean} scumxbag", f"{clean} " + "z" * 100 + "idiot") > 0.3).all()
    assert (score(clean, "", None, "a b c d e f g h", "z" * 5000) < 0.3).all()


def test_toxicity_cases(spark, docs, rows, nothing):
    labels = spark.createDataFrame([(i, k % 2, 1) for k, (i, *_) in enumerate(rows)] + [(None, 1, 1), (rows[0][0], None, 1)], "doc_id long, toxic int, text int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    none = labels.limit(0)
    assert {r["predicted"] for r in toxicity.toxicity(docs, none).collect()} == {0}
    assert toxicity.toxicity(nothing, none).count() == 0
    kept = toxicity.without_toxic(docs, none)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_letters_put_in_keep_a_kernel_value():
    marks = ["dumb", "scum", "moron", "idiot", "stupid"]
    got = toxicity.Kernel(marks).values(["duxmxb", "sxcxum", "moxrxoxn", "ixdixxot", "stxuxpxid"])
    assert (got.diagonal() > 0.1).all()


def test_spelled_out_words():
    kern = toxicity.Kernel(["dumb", "scum"])
    texts = ["so d u m b", "s c u m", "d - u - m - b", "s c * u m !", "d u", "m b", "d u is m b", "- - - - d"]
    got = toxicity.text_features(pa.array(texts, pa.string()), kern).max(1)
    assert (got[:4] > 0.99).all() and (got[4:] == 0).all()


def test_landmarks_of_a_large_lexicon():
    r = random.Random(8)
    lexicon = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(60)]
    toxic = [{*r.sample(lexicon, 8), *("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(60))} for _ in range(200)]
    assert len(toxicity.landmarks(toxic, [{"clean"}] * 200)) == 48


def test_fit_sample_passes_over_long_texts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FIT_BYTES", 6000)
    ids = sorted((i for i in range(80) if zlib.crc32(str(i).encode()) % 4 != 2), key=lambda i: zlib.crc32(f"fit {i}".encode()))[:40]
    for long in ([0], [5], [0, 1, 2]):
        made = [(i, "x" * 7000 if k in long else f"text {i}", k % 2 == 0) for k, i in enumerate(ids)]
        d = spark.createDataFrame([(i, t) for i, t, _ in made], "doc_id long, text string")
        texts, y = toxicity.sample(d, spark.createDataFrame([(i, int(x)) for i, _, x in made], "doc_id long, toxic int"))
        assert sorted(texts) == sorted(t for k, (_, t, _) in enumerate(made) if k not in long) and len(set(y)) == 2
    # texts that would fill the room alone don't keep the other class out
    kept = toxicity.chosen([(k, 0, 1900, True) for k in range(9)] + [(k, 1, 10, False) for k in range(9)])
    assert sum(n for (_, t), n in kept.items() if t) == 9 and sum(n for (_, t), n in kept.items() if not t) == 3


@needs_tables
def test_toxicity_held_out(spark):
    got = queries()["op6_toxicity"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"), "doc_id").filter("held_out")
    assert got.filter("predicted = toxic").count() >= 0.9 * got.count()


# --- 7 ----------------------------------------------------------------------------------------------------------------


def test_wavelet_matrix():
    r = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 3000):
        ids = r.integers(0, 40, n)
        m = wavelet.WaveletMatrix.load(wavelet.WaveletMatrix.build(ids, 6).dump())
        assert (m.decode() == ids).all()
        for i in r.integers(0, n, 40).tolist() if n else []:
            t = int(ids[i])
            assert m.access(i) == t and m.count(t, i) == int((ids[:i] == t).sum()) and m.locate(t, m.count(t, i)) == i
        assert m.count(41) == 0
        with pytest.raises(IndexError):
            m.locate(41, 0)


def test_token_files(spark, docs, rows, nothing):
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    got = sorted(map(tuple, wavelet.token_files(docs, path).collect()), key=lambda x: x[1])
    at, want = 0, []
    for i in [x[0] for x in got]:
        text = next(t for j, t, *_ in rows if j == i)
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want and [x[0] for x in got] == sorted(i for i, *_ in rows)
    assert wavelet.token_files(nothing, path).count() == 0


def test_chunks_equal_whole_texts():
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    t, coder, r = Tokenizer.from_file(path), wavelet.Encoder(path), random.Random(6)
    bits = ["the", " ", "  ", "\n", "\t ", "ñ", "é", " ", " ", "\u0085", "漢", "🙂", "\x1c", "'s", "don't", ".", ",", "!!", "12", "%", "<|endoftext|>", "<", "|", ">", ";", "×", "word", "Ω", "ا"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 30))) for _ in range(1500)]
    ids, n = coder.encode(pa.array(texts))
    for text, part in zip(texts, np.split(ids, np.cumsum(n)[:-1]), strict=True):
        assert part.tolist() == [*t.encode(text, add_special_tokens=False).ids, 2], repr(text)


# --- 8 ----------------------------------------------------------------------------------------------------------------


def test_jaccard(docs, rows, nothing):
    want = brute.components([(i, t) for i, t, *_ in rows])
    assert sorted(map(tuple, jaccard.jaccard_join(docs).collect())) == sorted(want)
    assert len({c for i, _, c in want if c != i}) >= 1
    assert jaccard.jaccard_join(nothing).count() == 0


@pytest.mark.parametrize("seed", [2, 3])
def test_jaccard_in_chunks(spark, seed, monkeypatch):
    r, v = random.Random(seed), vocabulary(seed, 60)
    rows, k = [], 0
    for _ in range(6):  # families at all distances that share passages
        base = [r.choice(v) for _ in range(r.choice([20, 60, 150]))]
        for _ in range(12):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 12))):
                w[r.randrange(len(w))] = r.choice(v)
            cut = r.randint(0, 8)
            rows.append((k, " ".join(w[cut:])))
            k += 1
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(jaccard, "SLICE", 2000)
    real = jaccard.links
    monkeypatch.setattr(jaccard, "links", lambda sets, folder, percent: real(sets, folder, percent, group=6))
    assert sorted(map(tuple, jaccard.jaccard_join(d).collect())) == brute.components(rows)


def test_sketch_bounds_the_distance():
    r = np.random.default_rng(3)
    for n in (10, 100, 700, 3000):
        a = r.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.r_[a[: n * 9 // 10], r.integers(0, 1 << 63, n // 8).astype(np.uint64)]
        x, y = (np.frombuffer(jaccard.sketch(s, len(s)), dtype=np.uint64) for s in (a, b))
        if len(x) == len(y):
            assert np.bitwise_count(x ^ y).sum() <= len(set(a.tolist()) ^ set(b.tolist()))


def test_one_of_each(docs, rows):
    kept = jaccard.one_of_each(docs.filter("doc_id IS NOT NULL"))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in brute.components([(i, t) for i, t, *_ in rows])})


# --- 9 ----------------------------------------------------------------------------------------------------------------


def test_a_difference_to_the_library_shows():
    coder = sp_bpe.Agenda(tokenizer_file("piece_bpe_32k.model"))
    texts = ["one of two", "two of three", "of"]
    ids, at, doubt = coder.encode(pa.array(texts))
    lists = [x.tolist() for x in np.split(ids, at[1:-1])]
    assert not doubt.any() and coder.checked(texts, lists, [True] * 3) == (lists, [True] * 3)
    wrong = [lists[0], lists[1][::-1], lists[2]]
    assert coder.checked(texts, wrong, [True] * 3) == (lists, [True, False, True])
    assert coder.checked(texts, wrong, [True, False, True]) == (wrong, [True] * 3) and coder.checked([], [], []) == ([], [])


def test_agenda_equals_the_library(docs, rows, nothing):
    path = tokenizer_file("piece_bpe_32k.model")
    coder, r = sp_bpe.Agenda(path), random.Random(9)
    lib = coder.library
    bits = ["the", " ", "   ", "\n", "▁", "ñ", "漢字", "🙂", " ", "\x00", "a", "b", "ing", "<s>", "</s>", "<0x41>", "1234", "ﬁ", "é", "WORLD", "internationalization"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 25))) for _ in range(800)] + [" ", "x" * 3000, None]
    ids, at, doubt = coder.encode(pa.array(texts, pa.string()))
    assert not doubt.any()
    for text, a, z in zip(texts, at, at[1:], strict=False):
        assert ids[a:z].tolist() == lib.encode(text or "", add_eos=True), repr(text)
    got = sp_bpe.sentencepiece_digest(docs, path).collect()
    assert len(got) == len(rows) and all(x["agrees"] for x in got)
    text = {i: t or "" for i, t, *_ in rows}
    for x in got:
        ids = lib.encode(text[x["doc_id"]], add_eos=True)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (x["n_tokens"], x["ids_sha256"], x["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids)))
    assert sp_bpe.sentencepiece_digest(nothing, path).count() == 0
    assert {len(x["ids"]) for x in sp_bpe.round_trip(docs.filter("text = ''"), path).collect()} == {1}


# --- 10 ---------------------------------------------------------------------------------------------------------------


def plain_nearest(rows, k=5, every=50):
    good = {}
    for i, v in rows:
        if i is not None and v and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, dtype=float)
    out = {}
    for q, a in good.items():
        if q % every == 0:
            near = sorted(((-(a @ b) / (np.linalg.norm(a) * np.linalg.norm(b)), i) for i, b in good.items() if i != q))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def test_nearest(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(12, 16))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 12] + r.normal(size=16) * 0.4]) for i in range(900)]
    same = rows[100][1]
    rows += [(900 + i, same) for i in range(60)] + [(2000, None), (2050, []), (2100, [0.0] * 16), (2150, [float("nan")] * 16), (2200, [None] + [1.0] * 15), (2250, [float("inf")] * 16), (2300, [1.0, 2.0]), (None, same)]
    rows += [rows[5], rows[50]]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("raw", F.lit(1)).repartition(4)
    got = defaultdict(list)
    for x in additive.nearest(d, shard=256, shortlist=48).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["vec_id"], x["score"], x["rank"]))
    want = plain_nearest(rows)
    assert set(got) == set(want)
    hit = sum(len({i for i, _, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit >= 0.9 * sum(map(len, want.values()))
    exact = {q: dict(w) for q, w in want.items()}
    for q, found in got.items():
        assert [x[2] for x in found] == list(range(1, 6)) and [(-s, i) for i, s, _ in found] == sorted((-s, i) for i, s, _ in found)
        assert all(math.isclose(s, exact[q][i], abs_tol=1e-12) for i, s, _ in found if i in exact[q])
    # the smallest of many equal vectors come first
    assert [i for i, _, _ in got[900]] == [100, 901, 902, 903, 904]


def test_nearest_of_few(spark):
    d = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [0.0, 2.0])], "vec_id long, embedding array<float>")
    got = sorted((x["query_id"], x["rank"], x["vec_id"]) for x in additive.nearest(d).collect())
    assert got == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]
    assert additive.nearest(d.limit(0)).count() == 0


def test_beam_search_beats_greedy():
    x = np.random.default_rng(5).normal(size=(400, 16))
    books = additive.fit(x, 4, 16)
    loss = lambda beam: ((x - sum(books[b][additive.encode(x, books, beam)[0][:, b]] for b in range(4))) ** 2).sum()
    codes, norms = additive.encode(x, books)
    assert loss(8) < loss(1)
    assert np.allclose(norms, np.linalg.norm(sum(books[b][codes[:, b]] for b in range(4)), axis=1))


# --- the pipeline -----------------------------------------------------------------------------------------------------


@needs_tables
def test_pipeline(spark, tmp_path):
    import corpus_pipeline as p
    from threadloom.llm.common import table

    sf = "/root/testdata/sf0.001"
    docs, before = table(spark, sf, "documents"), []
    for k, (name, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, sf)
        if k < 4:
            assert out.columns == list(p.COLUMNS)
        out.write.parquet(str(tmp_path / str(k)))
        before.append([r.asDict() for r in docs.collect()])
        docs = spark.read.parquet(str(tmp_path / str(k)))
    last = docs.collect()
    toxic = {r["doc_id"]: r["predicted"] for r in queries()["op6_toxicity"](spark, sf).collect()}
    assert {r["doc_id"] for r in before[1]} == {i for i, t in toxic.items() if not t}
    assert sorted(r["doc_id"] for r in before[2]) == sorted({c for _, _, c in brute.components([(r["doc_id"], r["text"]) for r in before[1]])})
    sha = lambda t: hashlib.sha256(" ".join(brute.words(t)).encode()).hexdigest()
    assert {(r["doc_id"], sha(r["text"])) for r in before[3]} == {(i, s) for i, n, gone, s in brute.substring_dedup([(r["doc_id"], r["text"]) for r in before[2]]) if not n or gone < n}
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in before[3]:
        n = len(brute.words(r["text"]))
        sizes[r["source"]] += n
        largest[r["source"]] = max(largest[r["source"]], n)
    for r in before[4]:
        taken[r["source"]] += len(brute.words(r["text"]))
    for s, want in plain_targets(dict(sizes)).items():
        assert abs(taken[s] - want) <= max(0.05 * want, largest[s])  # a source here has a handful of documents
    assert Counter(r["doc_id"] for r in last) == Counter(r["doc_id"] for r in before[4]) and all(r["agrees"] for r in last)
    assert len(json.dumps(p.ORACLE_SQL)) >= 4 and [n for n, _ in p.STAGES] and sorted(map(tuple, p.run(spark, sf).collect())) == sorted(map(tuple, last))
