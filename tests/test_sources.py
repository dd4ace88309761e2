import json

import pytest
from pyspark.sql import functions as F

from threadloom.operators import language, review
from threadloom.sources import files, markup


def fixture_post(i, comments=(), **more):
    return {"id": i, "name": f"t3_{i}", "subreddit": "s", "title": "t", "selftext": "", "created_utc": 1.0, "score": 1, "upvote_ratio": 0.5, "num_comments": 0, "permalink": "/x", "url": "u", "is_self": True, "over_18": False, "spoiler": False, "stickied": False, "locked": False, "archived": False, "is_original_content": False, "num_crossposts": 0, "author": "a", "comments": list(comments), **more}


def fixture_comment(i, parent, **more):
    return {"id": i, "name": f"t1_{i}", "link_id": "t3_p", "parent_id": parent, "subreddit": "s", "body": "b", "created_utc": 2.0, "score": 1, "depth": 0, "is_submitter": False, "stickied": False, "controversiality": 0, "permalink": "/y", "author": "a", **more}


@pytest.mark.parametrize(
    ("data", "wrong"),
    [
        ([fixture_post("p", [fixture_comment("c", "t3_p")])], []),
        ([fixture_post("p", title=None)], ["missing title"]),
        ([fixture_post("p", name="t1_p")], ["name must start with t3_"]),
        ([fixture_post("p", [fixture_comment("c", "t3_q")])], ["parent is another post"]),
        ([fixture_post("p", [fixture_comment("c", "t3_p", subreddit="z")])], ["subreddit differs from the post's"]),
        ([fixture_post("p", [fixture_comment("c", "t3_p", body=None)])], ["missing body"]),
        ([fixture_post("p", [fixture_comment("c", "t3_p"), fixture_comment("c", "t3_p")])], ["duplicate name", "duplicate name"]),
    ],
)
def test_fixture(spark, tmp_path, data, wrong):
    (tmp_path / "f.json").write_text(json.dumps({"schema_version": "1", "submissions": data}))
    rows = files.fixture(spark, str(tmp_path / "f.json"))
    assert rows.count() == sum(1 + len(p["comments"]) for p in data)
    assert [e for r in files.fixture_errors(rows).collect() for e in r["errors"]] == wrong
    if wrong:
        with pytest.raises(Exception, match="t[13]_"):
            files.fixture_errors(rows, strict=True).collect()


def test_listing(spark):
    page = json.dumps({"data": {"after": "t3_b", "children": [{"kind": "t3", "data": {"id": "a", "name": "t3_a", "title": "A"}}, {"kind": "t5", "data": {"id": "z"}}, {"kind": "t3", "data": {"title": "no id"}}]}})
    rows = markup.listing(spark.createDataFrame([(1, page), (2, "junk")], "page_no int, value string")).collect()
    assert [(r["page_no"], r["pos"], r["id"], r["after"]) for r in rows] == [(1, 0, "a", "t3_b")]


def test_comment_tree(spark):
    def node(i, replies=()):
        return {"kind": "t1", "data": {"id": i, "parent_id": "t3_p", "body": i, "created_utc": 1, "replies": {"data": {"children": list(replies)}} if replies else ""}}

    deep = node("d0")
    for k in range(1, 400):
        deep = node(f"d{k}", [deep])
    tree = [{}, {"data": {"children": [node("a", [node("b"), {"kind": "more", "data": {"count": 7}}]), node("c"), deep]}}]
    rows = markup.comment_tree(spark.createDataFrame([("p", json.dumps(tree)), ("q", "junk")], "post string, value string")).collect()
    assert [(r["id"], r["depth"]) for r in rows[:4]] == [("a", 0), ("b", 1), ("c", 0), ("d399", 0)]
    assert len(rows) == 403 and rows[-1]["depth"] == 399 and {r["more"] for r in rows} == {7}


PAGE = """<html><shreddit-post id="t3_p" post-title="T &amp; t" post-type="text" score="5" upvote-ratio="0.9" comment-count="2" created-timestamp="2026-08-20T12:22:10.758000+0000" permalink="/r/s/comments/p/x/" subreddit-name="r/s" author="ann" nsfw>
<div id="t3_p-post-rtjson-content"><p>post <b>body</b></p></div></shreddit-post>
<shreddit-post id="t3_ad" class="promotedlink" created-timestamp="1787228530"></shreddit-post>
<shreddit-comment thingid="t1_a" postid="t3_p" depth="0" score="x" created="1787228530758" author="bob" is-op="true"><div id="a-post-rtjson-content">first<div>in</div></div>
<shreddit-comment thingid="b" postid="p" parentid="a" depth="1" created="2026-08-20T12:22:10Z"><div id="b-post-rtjson-content">second</div></shreddit-comment></shreddit-comment>
<shreddit-comment id="zz" created="bad"></shreddit-comment></html>"""


def test_html(spark):
    found = markup.elements(spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>")], "page_id long, html string"))
    p = markup.posts(found).collect()
    assert len(p) == 1
    assert (p[0]["id"], p[0]["title"], p[0]["selftext"], p[0]["score"], p[0]["subreddit"], p[0]["is_self"], p[0]["over_18"], p[0]["stickied"]) == ("p", "T & t", "post body", 5, "s", True, True, False)
    assert p[0]["url"].endswith("/r/s/comments/p/x/") and p[0]["created_utc"].isoformat() == "2026-08-20T12:22:10.758000"
    c = {r["id"]: r for r in markup.comments(found, "fall").collect()}
    assert set(c) == {"a", "b"}
    assert (c["a"]["parent_id"], c["a"]["body"], c["a"]["is_submitter"], c["a"]["score"]) == ("t3_p", "firstin", True, 0)
    assert (c["b"]["name"], c["b"]["link_id"], c["b"]["parent_id"], c["b"]["subreddit"]) == ("t1_b", "t3_p", "t1_a", "fall")
    assert c["b"]["permalink"] == "/r/fall/comments/p/comment/b/"


def test_ids_and_defaults(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("t1_a # one\n\n#none\n t1_b\nt1_a\n")
    assert {r["item_id"] for r in files.id_list(spark, str(tmp_path / "ids.txt")).collect()} == {"t1_a", "t1_b"}
    d = spark.createDataFrame([("a", "s", None, None, "", "")], "id string, subreddit string, score long, upvote_ratio double, permalink string, url string")
    r = markup.with_archive_defaults(d).first()
    assert (r["score"], r["upvote_ratio"], r["permalink"]) == (0, 1.0, "/r/s/comments/a/") and r["url"].endswith(r["permalink"])
    assert spark.createDataFrame([("/r/s/comments/abc/x/",)], "u string").select(markup.id_of_permalink(F.col("u"))).first()[0] == "abc"


def test_cards_and_merge(spark):
    s = spark.createDataFrame([(1, 0, "t3_a", "/a", False, "old"), (1, 1, "t3_ad", "/x", True, ""), (2, 0, "t3_a", "/a", False, "new"), (2, 1, "t3_b", "/b", None, ""), (2, 2, "t3_c", "", False, ""), (3, 0, "q", "/q", False, "")], "snapshot_no int, pos int, id string, permalink string, promoted boolean, title string")
    assert {(r["id"], r["title"]) for r in files.cards(s).collect()} == {("t3_a", "old"), ("t3_b", "")}
    assert [r["id"] for r in files.cards(s, 1).collect()] == ["t3_a"]
    a = spark.createDataFrame([("x", 0, "p", 1), ("y", 1, "p", 1)], "id string, pos int, link_id string, v int")
    b = spark.createDataFrame([("x", 0, "p", 2), ("z", 1, "p", 2), ("w", 0, "q", 2)], "id string, pos int, link_id string, v int")
    assert {(r["id"], r["v"]) for r in files.merged(a, b).collect()} == {("x", 1), ("y", 1), ("z", 2), ("w", 2)}
    posts = spark.createDataFrame([("p", 3, False), ("q", 1, False)], "link_id string, listed long, truncated boolean")
    assert {r["id"] for r in files.topped_up(a, b, posts).collect()} == {"x", "y", "w"}
    assert {r["id"] for r in files.topped_up(a, b, posts.withColumn("listed", F.lit(9))).collect()} == {"x", "y", "z", "w"}


def test_endpoints(spark):
    lines = ["http://u:p@gw.some.example.com:80", "10.0.0.1:3128", "h.example.org:99:me:secret", "u:p@x.io:1", "nonsense", "# note", "h.example.org:99999"]
    got = {r["line_no"]: r for r in files.endpoints(spark.createDataFrame(list(enumerate(lines)), "line_no long, value string")).collect()}
    assert (got[0]["provider"], got[0]["masked"]) == ("example.com", "http://***:***@gw.some.example.com:80")
    assert got[1]["provider"] == "raw IP" and got[2]["user"] == "me" and got[3]["port"] == 1
    assert not got[4]["ok"] and not got[6]["ok"] and 5 not in got and "secret" not in str(got)


def test_endpoints_user_first_and_repeated(spark):
    lines = ["me:secret:h.example.org:99", "h.example.org:99:me:secret", "socks5://u:p@x.io:1", "x.io:1", "http://x.io:1", "junk", "a:b:c"]
    found = files.endpoints(spark.createDataFrame(list(enumerate(lines)), "line_no long, value string"))
    got = {r["line_no"]: r for r in found.collect()}
    assert (got[0]["user"], got[0]["host"], got[0]["port"], got[0]["repeated"]) == ("me", "h.example.org", 99, False)
    assert got[1]["repeated"] and got[4]["repeated"] and not got[3]["repeated"]
    assert files.endpoint_report(found).first().asDict() == {"kept": 3, "repeated": 2, "wrong_lines": [5, 6], "socks_with_user": 1}


def test_archive_prunes_and_dedups(spark, tmp_path):
    rows = [("a", "s1", "2026-08-01", 1), ("a", "s1", "2026-08-01", 1), ("b", "s1", "2026-08-02", 2), ("c", "s2", "2026-08-01", 3), ("d", "s1", "2026-08-09", 4)]
    spark.createDataFrame(rows, "id string, subreddit string, day string, created_utc long").write.partitionBy("subreddit", "day").json(str(tmp_path / "ar"))
    got = files.archive(spark, str(tmp_path / "ar"), ["s1"], "2026-08-01", "2026-08-02")
    assert {r["id"] for r in got.collect()} == {"a", "b"} and got.count() == 2


def test_answers(spark):
    good = '<think>{}</think>{"language": "english", "literal_sentiment": "positive", "intended_sentiment": "negative", "sarcastic": true, "confidence": 0.8, "rationale": "' + "r" * 500 + '", "cues": {"hyperbole": true}}'
    raw = spark.createDataFrame([("a", good), ("b", good.replace("english", "dutch")), ("c", good.replace("0.8", "1.8")), ("d", "sorry")], "item_id string, answer string")
    got = {r["item_id"]: r for r in language.parse_answers(raw).collect()}
    assert (got["a"]["sarcastic"], got["a"]["cue_hyperbole"], len(got["a"]["rationale"]), got["a"]["error"]) == (1, 1, 400, None)
    assert "language" in got["b"]["error"] and got["b"]["sarcastic"] is None and "confidence" in got["c"]["error"] and "sarcastic" in got["d"]["error"]


def test_plugged_models(spark):
    rows = spark.createDataFrame([("a", "good"), ("b", None)], "item_id string, text string")
    got = {r["item_id"]: r["label"] for r in language.sentiment(rows, lambda ts: [(0.9, 0.05, 0.05) if t else (0.1, 0.8, 0.1) for t in ts]).collect()}
    assert got == {"a": "positive", "b": "neutral"}

    fine = {"language": "english", "literal_sentiment": "neutral", "intended_sentiment": "negative", "sarcastic": True, "confidence": 1, "cues": {c.removeprefix("cue_"): False for c in language.CUES}}

    def client():
        calls = []

        def ask(p, *, schema, temperature):
            calls.append(p)
            assert list(schema["properties"])[:4] == ["language", "literal_sentiment", "cues", "sarcastic"] and len(schema["required"]) == 7
            if p == "down" or p == "once" and calls.count("once") < 2:
                raise RuntimeError("no answer")
            if p == "warm" and temperature == 0:
                return json.dumps(fine | {"confidence": 7})
            if p == "bad":
                return "I cannot say"
            return "<think>{ hm }</think>" + json.dumps(fine)

        return ask

    prompts = spark.createDataFrame([(x, x) for x in ("good", "down", "once", "warm", "bad")], "item_id string, prompt string").coalesce(1)
    asked = language.annotate(prompts, client, pause=lambda n: 0.0).cache()
    got = {r["item_id"]: (r["attempts"], r["call_error"], r["answer"] is not None) for r in asked.collect()}
    assert got == {"good": (1, None, True), "down": (3, "failed after 3 attempts: no answer", False), "once": (2, None, True), "warm": (3, None, True), "bad": (3, "failed after 3 attempts: no JSON object", False)}
    votes, failures = language.votes_and_failures(asked, "m", "v1", "adjudicator")
    assert {(r["item_id"], r["sarcastic"], r["role"]) for r in votes.collect()} == {(x, 1, "adjudicator") for x in ("good", "once", "warm")}
    assert {(r["item_id"], r["model_key"]) for r in failures.collect()} == {("down", "m"), ("bad", "m")}
    with pytest.raises(ValueError):
        language.annotate(prompts, client, attempts=0)


@pytest.mark.parametrize(("change", "why"), [({}, None), ({"language": "latin"}, "language is latin"), ({"sarcastic": 1}, "sarcastic is no boolean"), ({"confidence": True}, "confidence is no number"), ({"confidence": -0.1}, "confidence is -0.1"), ({"cues": {}}, "cues lacks polarity_inversion"), ({"literal_sentiment": None}, "missing literal_sentiment"), ({"rationale": "x" * 999}, None)])
def test_faults_of_answers(change, why):
    fine = {"language": "english", "literal_sentiment": "neutral", "intended_sentiment": "negative", "sarcastic": True, "confidence": 1, "cues": {c.removeprefix("cue_"): False for c in language.CUES}}
    assert language.fault_of("so: " + json.dumps(fine | change) + " there") == why
    assert language.fault_of("{ not json }").startswith("no JSON") and language.fault_of("") == "no JSON object" == language.fault_of(None)


def test_prompt_guard(spark):
    stored = spark.createDataFrame([("v1", language.content_hash("a"))], "prompt_version string, content_hash string")
    language.check_version(stored, "v1", language.content_hash("a"))
    language.check_version(stored, "v2", "other")
    with pytest.raises(RuntimeError):
        language.check_version(stored, "v1", language.content_hash("b"))


def test_review_rows(spark):
    keys = ", ".join(f"{k} {'string' if k in ('language', 'literal_sentiment', 'intended_sentiment', 'sarcastic_span') else 'int'}" for k in review.LABEL_KEYS)
    label = (1, "english", "neutral", "negative", 0, 0, 0, 0, None, 0)
    other = (0, *label[1:])
    new = spark.createDataFrame([("a", *other, "n", 1, 1), ("b", *other, "", 1, 1), ("c", *other, None, 1, 1)], f"item_id string, {keys}, notes string, is_gold int, votes_seen int")
    old = spark.createDataFrame([("b", *label, '{"kept": 1}', 1, 0, "t0", "t1"), ("c", *label, None, 0, 0, None, "t1")], f"item_id string, {keys}, first_pass_json string, assist_seen int, votes_seen int, first_reviewed_at string, reviewed_at string")
    got = {r["item_id"]: r for r in review.save_reviews(new, old).collect()}
    assert json.loads(got["a"]["first_pass_json"])["sarcastic"] == 0 and got["a"]["votes_seen"] == 1 and got["a"]["first_reviewed_at"] is None
    assert got["b"]["first_pass_json"] == '{"kept": 1}' and (got["b"]["assist_seen"], got["b"]["votes_seen"], got["b"]["notes"]) == (1, 0, None)
    assert json.loads(got["c"]["first_pass_json"])["sarcastic"] == 1 and got["c"]["first_reviewed_at"] == "t1"
    tips = spark.createDataFrame([("b",), ("z",)], "item_id string")
    assert [r[0] for r in review.revealable(tips, old).collect()] == ["b"]
    shown = {r["item_id"]: r["assist_seen"] for r in review.reveal(old, spark.createDataFrame([("c",), ("z",)], "item_id string"), spark.createDataFrame([("c",)], "item_id string")).collect()}
    assert shown == {"b": 1, "c": 1}


def test_assist_lines(spark):
    corpus = spark.createDataFrame([("a", "some text")], "item_id string, text string")
    lines = spark.createDataFrame([("a", 0.5, "text"), ("q", 0.5, None), ("a", 2.0, "nope")], "item_id string, confidence double, sarcastic_span string")
    bad = [tuple(r["errors"]) for r in review.assist_errors(lines, corpus).orderBy("confidence", "item_id").collect()]
    assert bad == [("given twice",), ("not in the corpus",), ("given twice", "confidence outside 0 to 1", "span is no part of the text")]


def test_prompts_do_not_all_become_text_at_once(spark):
    """A batch is asked out of its Arrow buffers, prompt by prompt, without a copy of it in pandas; more prompts than leave at once all come back."""
    prompts = spark.range(450).select(F.concat(F.lit("i"), F.col("id").cast("string")).alias("item_id"), F.lit("what?").alias("prompt")).coalesce(1)
    asked = language.annotate(prompts, lambda: lambda p, *, schema, temperature: "no", attempts=1)
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan
    assert sorted(r["item_id"] for r in asked.collect()) == sorted(f"i{n}" for n in range(450))
