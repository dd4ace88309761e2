import json
import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators import candidates, corpus, export, history, state, threads, views
from threadloom.plans import catalog
from threadloom.sources import files

KEY = b"k"


def post(i, title="A title here", selftext="some words in the body", **more):
    return {"record_type": "submission", "reddit_fullname": f"t3_{i}", "reddit_id": i, "subreddit": "s", "title": title, "selftext": selftext, "created_utc": "2026-08-20T10:00:00Z", "is_self": True, "author_status": "pseudonymized", "author_hash": "h0", **more}


def comment(i, parent, minute, body="a fine comment of words", depth=0, **more):
    return {"record_type": "comment", "reddit_fullname": f"t1_{i}", "reddit_id": i, "subreddit": "s", "submission_id": "sub1", "parent_id": parent, "body": body, "created_utc": f"2026-08-20T11:{minute:02d}:00Z", "depth": depth, "author_status": "pseudonymized", "author_hash": f"h{minute % 3}", **more}


RECORDS = [
    post("sub1"), comment("c1", "t3_sub1", 0), comment("c2", "t1_c1", 1, depth=1), comment("c3", "t1_c2", 2, depth=2), comment("c4", "t1_c1", 5, depth=1), comment("c5", "t1_c1", 6, depth=1),
    comment("bot1", "t3_sub1", 7, author="AutoModerator"), comment("short1", "t3_sub1", 8, "ok"), comment("del1", "t3_sub1", 9, "[deleted]", author_status="deleted"), comment("url1", "t3_sub1", 10, "https://x.example/abc wow"),
    post("link1", "Look at this picture now", "", is_self=False),
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw") / "s"
    d.mkdir()
    (d / "2026-08-20.jsonl").write_text("\n".join(map(json.dumps, RECORDS)) + "\nnot json\n[1]\n\n" + json.dumps({"record_type": "comment"}) + "\n")
    (d / "2026-08-21.jsonl").write_text(json.dumps(comment("c1", "t3_sub1", 59, "a later copy of it")) + "\n")
    return str(d.parent)


@pytest.fixture(scope="module")
def rows(spark, folder):
    return corpus.index(files.jsonl(spark, folder).filter("NOT bad").drop("item_id", "bad")).withColumn("created_s", F.unix_seconds("ts")).cache()


def test_scan_counts_and_first_wins(spark, folder, rows):
    read = files.jsonl(spark, folder)
    assert read.filter("bad").count() == 3 and read.filter("NOT bad").count() == 11
    assert files.jsonl(spark, folder, unique=False).filter("NOT bad").count() == 12
    assert rows.filter("item_id = 't1_c1'").first()["text"] == "a fine comment of words"
    assert tuple(corpus.counts(rows).first()) == (11, 2, 9)
    assert "author" not in rows.columns


def test_reasons(rows):
    got = {r["item_id"]: r["exclusion_reason"] for r in candidates.select(rows).collect()}
    assert got["t3_sub1"] is got["t1_c1"] is got["t1_c3"] is None
    assert (got["t1_bot1"], got["t1_short1"], got["t1_del1"], got["t1_url1"], got["t3_link1"]) == ("bot_author", "too_short", "deleted_author", "too_short", "link_post")


def test_phatic_freeze(spark, rows):
    more = rows.filter("item_id = 't1_c1'").withColumn("text", F.lit("happy birthday po ate"))
    votes = spark.createDataFrame([("t1_c1", "annotator")], "item_id string, role string")
    free, held = candidates.select(more).first(), candidates.select(more, votes).first()
    assert (free["eligible"], free["exclusion_reason"], free["phatic"]) == (False, "phatic", True)
    assert (held["eligible"], held["exclusion_reason"], held["phatic"]) == (True, None, True)


def test_chain_children_depth(rows):
    chain = {r["item_id"]: [x["item_id"] for x in r["chain"]] for r in threads.ancestors(rows).collect()}
    assert chain["t1_c3"] == ["t1_c1", "t1_c2"] and chain["t1_c1"] == [] and chain["t3_sub1"] == []
    kids = {r["parent_item"]: [x["item_id"] for x in r["replies"]] for r in threads.children(rows).collect()}
    assert kids["t1_c1"] == ["t1_c2", "t1_c4", "t1_c5"] and len(kids["t3_sub1"]) == 3
    depth = {r["item_id"]: r["depth_found"] for r in threads.depths(rows).collect()}
    assert depth["t1_c1"] == 0 and depth["t1_c3"] == 2


def test_deep_chain_and_dangling_parent(spark):
    made = [("t3_p", "submission", None)] + [(f"t1_{i:03d}", "comment", "t3_p" if i == 0 else f"t1_{i - 1:03d}") for i in range(40)] + [("t1_lost", "comment", "t1_gone")]
    c = spark.createDataFrame([(i, k, "t3_p", p, None, "x", 0, "h", n) for n, (i, k, p) in enumerate(made)], "item_id string, record_type string, submission_item string, parent_item string, depth int, text string, is_submitter int, author_hash string, created_s long")
    depth = {r["item_id"]: r["depth_found"] for r in threads.depths(c).collect()}
    assert depth["t1_039"] == 39 and depth["t1_000"] == 0 and depth["t1_lost"] == 1
    chain = {r["item_id"]: [x["item_id"] for x in r["chain"]] for r in threads.ancestors(c).collect()}
    assert chain["t1_039"] == [f"t1_{i:03d}" for i in range(33, 39)] and chain["t1_lost"] == []


def test_reach_of_thread_queries(spark, tmp_path):
    spark.createDataFrame([(1, n, "user", "words") for n in range(600)], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    up = [299, 149, 74, 36, 17, 8, 3, 1]
    last = lambda q: catalog.QUERIES[q](spark, str(tmp_path)).filter("item_id = 't1_1_599'").first()
    assert last("g01_ancestors")["chain"] == "".join(f"t1_1_{n}>" for n in reversed(up))
    assert last("g02_depths")["depth_found"] == len(up) and last("g03_thread_lines")["indent"] == len(up) + 1


def test_chains_deeper_than_any_stretch(spark):
    made = [("t3_p", "submission", None)] + [(f"t1_{i:03d}", "comment", "t3_p" if i == 0 else f"t1_{i - 1:03d}") for i in range(560)] + [("t1_a", "comment", "t1_b"), ("t1_b", "comment", "t1_a")]
    c = spark.createDataFrame([(i, k, "t3_p", p, None, "x", 0, "h", n) for n, (i, k, p) in enumerate(made)], "item_id string, record_type string, submission_item string, parent_item string, depth int, text string, is_submitter int, author_hash string, created_s long").coalesce(1)
    depth = {r["item_id"]: r["depth_found"] for r in threads.depths(c).collect()}
    assert (depth["t1_300"], depth["t1_499"], depth["t1_559"], depth["t1_a"]) == (300, 499, 500, 500)
    few = c.filter("created_s <= 20 OR item_id IN ('t1_a', 't1_b')")
    assert {r["item_id"]: r["indent"] for r in threads.pre_order(few).collect()} == {"t3_p": 0, "t1_a": 1, "t1_b": 1} | {f"t1_{i:03d}": i + 1 for i in range(20)}
    chain = {r["item_id"]: len(r["chain"]) for r in threads.ancestors(few, threads.ANCESTORS).collect()}
    assert chain["t1_019"] == 19 and chain["t1_a"] == 50


def replies(spark, ups, threads_of=None):
    """Rows of one thread, or of those given, from their parents."""
    made = [(i, "submission" if u is None and i.startswith("t3") else "comment", (threads_of or {}).get(i, "t3_p"), u, n % 3, f"text of {i}", n) for n, (i, u) in enumerate(ups.items())]
    return spark.createDataFrame(made, "item_id string, record_type string, submission_item string, parent_item string, depth int, text string, created_s long").withColumns({"is_submitter": F.lit(0), "author_hash": F.lit("h"), "author_status": F.lit("pseudonymized"), "title": F.lit("a title"), "body": F.col("text"), "permalink": F.lit("/p")})


def test_order_within_a_thread():
    """The walk against every row's own way up, circles and lost parents included."""
    r = random.Random(5)
    for _ in range(400):
        ids = [f"t{i}" for i in range(r.randint(1, 9))]
        keys, ids = map(list, zip(*sorted((f"{r.randint(0, 3)}|{x}", x) for x in ids), strict=True))
        ups, at, want = [r.choice([None, "gone", *ids]) for _ in ids], {x: i for i, x in enumerate(ids)}, []
        for i in range(len(ids)):
            way, u = [i], ups[i]
            while u in at and at[u] not in way:
                way.append(at[u])
                u = ups[at[u]]
            want.append(([keys[x] for x in reversed(way)], i, len(way) - 1, way[-1]))
        assert list(threads._in_order(ids, ups, keys)) == [(i, d, top) for _, i, d, top in sorted(want)]


def test_paths_do_not_grow_with_depth(spark):
    deep = replies(spark, {"t3_p": None} | {f"t1_{i:03d}": f"t1_{i - 1:03d}" if i else "t3_p" for i in range(200)})
    got = threads.pre_order(deep).select("item_id", "path", "indent").orderBy("path").collect()
    assert [r["indent"] for r in got] == list(range(201)) and max(len(r["path"]) for r in got) < 20


def test_threads_that_no_group_holds_have_the_same_lines(spark, monkeypatch):
    ups = {"t3_p": None, "t3_q": None} | {f"t1_{i}": f"t1_{(i - 1) // 2}" if i > 1 else "t3_p" for i in range(30)} | {"t1_x": "t1_7", "t1_y": "t1_x", "t1_lost": "t1_gone", "t1_r": "t1_s", "t1_s": "t1_r", "t1_z": "t3_none"}
    of = {"t3_q": "t3_q", "t1_x": "t3_q", "t1_y": "t3_q", "t1_z": "t3_none"}  # a reply in one thread to a comment in another
    lines = lambda rows: [tuple(r) for r in threads.rendered(rows).orderBy("thread", "path").select("thread", "item_id", "line").collect()]
    both, own = replies(spark, ups, of), replies(spark, {i: u for i, u in ups.items() if i not in ("t1_x", "t1_y")}, of)
    within = lines(own)
    assert [x for x in lines(both) if x[1] not in ("t1_x", "t1_y")] == within
    assert next(x for x in lines(both) if x[1] == "t1_y") == ("t3_p", "t1_y", "  " * 5 + "└ [comment y] u/h  text of t1_y")
    monkeypatch.setattr(threads, "ORDERED_ROWS", 3)
    assert lines(own) == within


@pytest.mark.parametrize("cuts", [(None, None), (9, 4)])
def test_ancestors_by_groups_and_by_joins(spark, monkeypatch, cuts):
    ups = {"t3_p": None} | {f"t1_{i}": f"t1_{(i - 1) // 2}" if i > 1 else "t3_p" for i in range(30)} | {"t1_x": "t1_29", "t1_y": "t1_x", "t1_lost": "t1_gone", "t1_r": "t1_s", "t1_s": "t1_r", "t1_alone": "t1_5"}
    rows = replies(spark, ups, {"t1_x": "t3_q", "t1_y": "t3_q", "t1_alone": None})
    wanted = rows.filter("created_s % 2 = 0")

    def chains(levels, of):
        return {r["item_id"]: [tuple(x) for x in r["chain"]] for r in threads.ancestors(rows, levels, of, *cuts).collect()}

    for levels, of in ((1, None), (3, wanted), (50, None)):
        got, ids = chains(levels, of), {r["item_id"] for r in (rows if of is None else of).collect()}
        assert set(got) == ids
        for i in ids:
            way, u = [], ups[i]
            while u in ups and u.startswith("t1_") and len(way) < levels:
                way.append(u)
                u = ups[u]
            assert [x[0] for x in got[i]] == way[::-1]
        monkeypatch.setattr(threads, "CHAINED_ROWS", 2)
        assert chains(levels, of) == got
        monkeypatch.undo()


def test_ancestors_shuffle_a_row_once(spark):
    """However many levels: no join of rows with their ancestors."""
    plan = threads.ancestors(replies(spark, {"t3_p": None, "t1_a": "t3_p", "t1_b": "t1_a"}), threads.ANCESTORS)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_context(spark, rows):
    ctx = {r["item_id"]: r for r in threads.contexts(rows).collect()}
    c2 = ctx["t1_c2"]
    assert c2["submission"]["item_id"] == "t3_sub1" and [p["item_id"] for p in c2["parent_chain"]] == ["t1_c1"] and [p["item_id"] for p in c2["replies"]] == ["t1_c3"]
    assert c2["context_text"].split("\n") == ["=== THREAD CONTEXT ===", "[SUBMISSION r/s] A title here", "some words in the body", "[PARENT depth=0] a fine comment of words", "[REPLY 1] a fine comment of words"]
    top = ctx["t3_sub1"]
    assert top["submission"] is None and top["parent_chain"] == [] and len(top["replies"]) == 3
    small = {r["item_id"]: r["context_text"] for r in threads.contexts(rows, max_chars=30).collect()}
    assert all(len(x) <= 31 for x in small.values())
    stored = spark.createDataFrame([("t1_c2", "v1", "as it was")], "item_id string, prompt_version string, context_text string")
    again = {r["item_id"]: r["context_text"] for r in threads.reuse(stored, rows, rows.select("item_id").filter("item_id IN ('t1_c2', 't1_c3')"), "v1").collect()}
    assert again["t1_c2"] == "as it was" and again["t1_c3"].startswith("=== THREAD")


def test_pre_order(rows):
    lines = [(r["item_id"], r["indent"]) for r in threads.pre_order(rows).filter("submission_item = 't3_sub1'").orderBy("path").collect()]
    assert lines[:6] == [("t3_sub1", 0), ("t1_c1", 1), ("t1_c2", 2), ("t1_c3", 3), ("t1_c4", 2), ("t1_c5", 2)]


def test_inherit_and_retag(spark, rows):
    c = rows.withColumn("sampling_strategy", F.when(F.col("item_id") == "t3_sub1", "keyword_oversampled")).withColumn("matched_query_or_keyword", F.when(F.col("item_id") == "t3_sub1", "2026-06-01"))
    got = {r["item_id"]: r["sampling_strategy"] for r in corpus.inherit_sampling(c).collect()}
    assert got["t1_c2"] == "keyword_oversampled" and got["t3_link1"] is None
    once = state.retag(c)
    assert once.filter("retagged").count() == 1
    assert state.retag(once.drop("retagged")).filter("retagged").count() == 0


def test_normalized_drops_names(spark):
    raw = spark.createDataFrame([("submission", "p1", None, None, "Alice", None), ("comment", "c1", "t3_p1", "t1_x", None, None)], "record_type string, id string, link_id string, parent_id string, author string, depth int")
    got = {r["id"]: r for r in corpus.normalized(raw, "run", KEY).collect()}
    assert "author" not in corpus.normalized(raw, "run", KEY).columns
    assert got["p1"]["author_status"] == "pseudonymized" and got["c1"]["author_status"] == "unavailable"
    assert got["c1"]["submission_id"] == "p1" and got["c1"]["parent_record_type"] == "comment" and got["c1"]["depth"] == 0


def test_author_history(spark):
    base = 1_785_542_400
    hours = [("A", 0), ("A", 216), ("A", 240), ("A", 250), ("B", 250), (None, 250), ("A", 250)]
    e = spark.createDataFrame([(i, a, (base + h * 3600) * 1_000_000) for i, (a, h) in enumerate(hours)], "item_id long, author string, us long")
    got = {r["item_id"]: tuple(r[c] for c in ("n_48", "n_168", "n_720", "n_all")) for r in history.history_counts(e).collect()}
    assert got[3] == (2, 2, 3, 3) and got[6] == got[3] and got[4] == got[5] == (0, 0, 0, 0)
    cover = {r["window"]: r for r in history.coverage(history.history_counts(e).filter("item_id IN (3, 4)")).collect()}
    assert (cover["48h"]["at_least_1"], cover["48h"]["at_least_3"], cover["48h"]["full"], cover["48h"]["mean_available"]) == (0.5, 0.0, 0.0, 1.0)
    last = {r["item_id"]: r["history"] for r in history.last_posts(e.filter("author IS NOT NULL")).collect()}
    assert last[3] == [1, 2] and last[4] == []


def test_daily_sample_is_fixed(spark):
    rows = spark.createDataFrame([(i, "2026-08-01") for i in range(40)], "item_id long, day string")
    a, b = ({r["item_id"] for r in history.daily_sample(x, ["day"], "item_id", 5).collect()} for x in (rows, rows.orderBy(F.desc("item_id"))))
    assert a == b and len(a) == 5 and a != set(range(5))


def test_state(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "item_id string, v int")
    delta = spark.createDataFrame([("b", 9), ("c", 3), ("c", 4)], "item_id string, v int")
    assert sorted(map(tuple, state.upsert(base, delta.filter("v <> 4"), ["item_id"]).collect())) == [("a", 1), ("b", 9), ("c", 3)]
    new = state.insert_new(base, delta, ["item_id"])
    assert sorted(map(tuple, new.collect())) == [("a", 1), ("b", 2), ("c", 3)]
    assert state.insert_new(new, delta, ["item_id"]).count() == 3
    assert state.parse_extend("2026-06=3, 2026-10:2") == {"2026-06": 3, "2026-10": 2}
    for wrong in ("", "2026-13=1", "2026-06", "x=1", "2026-06=0", "2026-06=1,2026-06=2"):
        with pytest.raises(ValueError):
            state.parse_extend(wrong)


def test_fork(spark):
    months = [(f"i{k}", "2026-06" if k % 2 else "2026-10") for k in range(20)]
    c = spark.createDataFrame(months, "item_id string, month string")
    none = spark.createDataFrame([("i1",)], "item_id string")
    draw = [sorted(r["item_id"] for r in state.extension_sample(c, none, {"2026-06": 3, "2026-10": 2}).collect()) for _ in range(2)]
    assert draw[0] == draw[1] and len(draw[0]) == 5 and "i1" not in draw[0]
    assert state.extension_sample(c, none, {"2026-06": 50}).count() == 9
    ratings = spark.createDataFrame([("x", "a1", "v1", "annotator"), ("x", "zz", "v1", "annotator"), ("x", "a1", "v0", "annotator")], "item_id string, model_key string, prompt_version string, role string")
    agg = spark.createDataFrame([("x", "v1", 1), ("y", "v1", None)], "item_id string, prompt_version string, sarcastic_final int")
    queue = spark.createDataFrame([("x", "gold"), ("y", "low_confidence")], "item_id string, reason string")
    made = state.fork(ratings, agg, queue, c.filter("item_id = 'i3'"), ["a1"], "v1")
    assert {k: v.count() for k, v in made.items()} == {"ratings": 1, "aggregates": 0, "queue": 1, "target_priority": 2}


def test_dump_scope(rows):
    picked = rows.filter("item_id = 't1_c1'").select("item_id")
    own = {r["item_id"] for r in export.corpus_dump(rows, picked).collect()}
    h = rows.filter("item_id = 't1_c1'").first()["author_hash"]
    assert own == {r["item_id"] for r in rows.filter(F.col("author_hash") == h).collect()}
    assert export.corpus_dump(rows, picked, "all").count() == rows.count()
    with pytest.raises(ValueError):
        export.corpus_dump(rows, picked, "some")


def test_browser_and_page(rows):
    got = {r["item_id"]: r for r in views.browser(rows).collect()}
    assert got["t1_c1"]["reply_to"] == "post" and got["t1_c2"]["reply_to"] == "t1_c1" and got["t3_sub1"]["reply_to"] is None and got["t1_c2"]["post_title"] == "A title here"
    first = [r["item_id"] for r in views.page(rows, views.browsing_order(), 1, 4).collect()]
    second = [r["item_id"] for r in views.page(rows, views.browsing_order(), 2, 4).collect()]
    assert len(first) == 4 and not set(first) & set(second)
    assert views.masks(rows, needle="A FINE").count() == 6  # c1 to c5 and the bot


@pytest.mark.parametrize("span", [1, 3 * history.HOUR, history.SPAN])
def test_history_by_spans(spark, span):
    r = random.Random(4)
    rows = [(k, r.choice(["hot"] * 5 + ["a", "b", None]), r.choice([None] + [r.randrange(0, 90 * 24) * history.HOUR // 2 for _ in range(9)])) for k in range(300)]
    d = spark.createDataFrame(rows, "item_id long, author string, us long").repartition(3)
    got = {x["item_id"]: (x["n_48"], x["n_168"], x["n_720"], x["n_all"]) for x in history.history_counts(d, span=span).collect()}
    for i, a, t in rows:
        mine = [u for _, b, u in rows if a is not None and b == a and t is not None and u is not None and u < t]
        assert got[i] == tuple(min(5, sum(h is None or u >= t - h * history.HOUR for u in mine)) for h in history.WINDOWS)
