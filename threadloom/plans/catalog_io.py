"""More queries, of sources, sinks, states and expressions: the driver's tables are written out in the shapes that the engine reads and read back,
or take an operator's way through tables made of them. Each has the SQL that says the same in DuckDB."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import identity, text, timeutil
from ..keyed import KeyedTable
from ..operators import agreement, corpus, export, language, review, state, threads, views
from ..schemas import RATING
from ..scratch import folder, hadoop, held, listed
from ..sources import files, indexed, lines, markup, paged
from ..streaming import awaiting, ingest
from .adapters import view
from .catalog import _AGG, _EXP, _LIST, G04, KEY, LINEUP, ORACLES, VERSION, _aggregates, _exported, _hmac_sql, _with, query

# --- JSON lines ----------------------------------------------------------------------------------------------------------

_ISO = "strftime(to_timestamp(created_s) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ')"


def _iso(c: str = "created_s"):
    return F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _records(s: SparkSession, d: str) -> DataFrame:
    """The corpus view as records, names included."""
    c = view(s, d, "corpus")
    return c.select(
        "record_type", F.col("item_id").alias("reddit_fullname"), F.substring("item_id", 4, 1 << 30).alias("reddit_id"), "subreddit", "title", "selftext", "body", F.substring("submission_item", 4, 1 << 30).alias("submission_id"), F.col("submission_item").alias("link_id"),
        F.col("parent_item").alias("parent_id"), _iso().alias("created_utc"), "score", "depth", "permalink", F.col("is_self").cast("boolean").alias("is_self"), F.col("is_submitter").cast("boolean").alias("is_submitter"), F.col("stickied").cast("boolean").alias("stickied"),
        "distinguished", "author", "author_hash", "author_status", _iso().alias("retrieved_at_utc"), "sampling_strategy", "matched_query_or_keyword",
    )


def _written(s: SparkSession, d: str) -> str:
    """Records as JSON lines by subreddit and day, every third one twice, and one broken line in ten comments' places."""
    at = folder(s)
    r = _records(s, d)
    files.write_records(r, f"{at}/raw")
    files.write_records(r.filter("score % 3 = 0"), f"{at}/raw")
    bad = r.filter("record_type = 'comment' AND score % 10 = 0").select(F.concat(F.lit('{"record_type": '), F.col("reddit_fullname")).alias("value"))
    bad.write.mode("append").json(f"{at}/raw/broken")  # objects without an identity
    return f"{at}/raw"


@query("SELECT item_id, false AS bad, subreddit FROM corpus UNION ALL SELECT NULL, true, NULL FROM corpus WHERE record_type = 'comment' AND score % 10 = 0", "corpus")
def s01_jsonl(s: SparkSession, d: str) -> DataFrame:
    """Each identity once, lines without one marked."""
    return files.jsonl(s, _written(s, d)).select("item_id", "bad", "subreddit")


@query(f"SELECT count(*) AS total, sum((record_type = 'submission')::INT)::BIGINT AS submissions, sum((record_type = 'comment')::INT)::BIGINT AS comments FROM corpus", "corpus")
def s01_index_counts(s: SparkSession, d: str) -> DataFrame:
    """Scan, normalize, index: the path whose throughput the data contract's tool has published."""
    return corpus.counts(corpus.index(files.jsonl(s, _written(s, d)).filter("NOT bad").drop("item_id", "bad")))


@query(
    f"SELECT item_id, record_type, subreddit, CASE WHEN record_type = 'submission' THEN item_id ELSE submission_item END AS submission_item, CASE WHEN record_type = 'comment' THEN parent_item END AS parent_item, depth, epoch_us(to_timestamp(created_s))::BIGINT AS us, "
    "(lower(author) = 'automoderator' OR coalesce(author_hash = " + _hmac_sql("'automoderator'") + ", false))::INT AS is_bot, coalesce(stickied, 0)::INT AS stickied, is_self::INT AS is_self, is_submitter::INT AS is_submitter, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text FROM corpus",
    "corpus",
)
def p04_indexed(s: SparkSession, d: str) -> DataFrame:
    """Records to corpus rows."""
    got = corpus.index(_records(s, d).withColumn("id", F.col("reddit_id")), KEY)
    return got.select("item_id", "record_type", "subreddit", "submission_item", "parent_item", "depth", F.unix_micros("ts").alias("us"), "is_bot", "stickied", "is_self", "is_submitter", F.regexp_replace("text", r"^\s+|\s+$", "").alias("text"))


@query(
    "SELECT item_id, 'run-1' AS collection_run_id, " + _hmac_sql("lower(trim(author))") + " AS author_hash, 'pseudonymized' AS author_status, CASE WHEN record_type = 'comment' THEN CASE WHEN starts_with(parent_item, 't3_') THEN 'submission' ELSE 'comment' END END AS parent_record_type, "
    "CASE WHEN record_type = 'comment' THEN substring(submission_item, 4) END AS submission_id, CASE WHEN record_type = 'comment' THEN coalesce(depth, 0) END::INT AS depth, coalesce(stickied, 0) <> 0 AS stickied, 'natural' AS sampling_strategy FROM corpus",
    "corpus",
)
def p01_normalized(s: SparkSession, d: str) -> DataFrame:
    """Raw rows of either kind to records; names go."""
    got = corpus.normalized(_records(s, d), "run-1", KEY)
    return state.scrub(got).select(F.col("reddit_fullname").alias("item_id"), "collection_run_id", "author_hash", "author_status", "parent_record_type", "submission_id", F.col("depth").cast("int").alias("depth"), "stickied", "sampling_strategy")


@query("SELECT item_id, CASE WHEN score % 2 = 0 THEN score ELSE 0 END AS score, '/r/' || subreddit || '/comments/' || substring(item_id, 4) || '/' AS permalink, 'https://www.reddit.com/r/' || subreddit || '/comments/' || substring(item_id, 4) || '/' AS url, 1.0::DOUBLE AS upvote_ratio FROM corpus WHERE record_type = 'submission'", "corpus")
def p03_archive_defaults(s: SparkSession, d: str) -> DataFrame:
    r = view(s, d, "corpus").filter("record_type = 'submission'")
    raw = r.select("item_id", F.substring("item_id", 4, 1 << 30).alias("id"), "subreddit", F.when(F.col("score") % 2 == 0, F.col("score")).alias("score"), F.lit("").alias("permalink"), F.lit("").alias("url"), F.lit(None).cast("double").alias("upvote_ratio"))
    return markup.with_archive_defaults(raw).select("item_id", "score", "permalink", "url", "upvote_ratio")


# --- nested and partitioned sources --------------------------------------------------------------------------------------


def _fixture_rows(s: SparkSession, d: str) -> DataFrame:
    c = view(s, d, "corpus")
    kid = F.struct(
        F.substring("item_id", 4, 1 << 30).alias("id"), F.col("item_id").alias("name"), F.col("submission_item").alias("link_id"), F.col("parent_item").alias("parent_id"), F.when(F.col("score") % 13 != 0, F.col("subreddit")).otherwise("elsewhere").alias("subreddit"), "body",
        F.col("created_s").cast("double").alias("created_utc"), "score", "depth", F.col("is_submitter").cast("boolean").alias("is_submitter"), F.lit(False).alias("stickied"), F.lit(0).alias("controversiality"), "permalink", F.when(F.col("score") % 7 != 0, F.col("author")).alias("author"),
    )
    kids = c.filter("record_type = 'comment'").groupBy("submission_item").agg(F.array_sort(F.collect_list(kid)).alias("comments"))
    posts = c.filter("record_type = 'submission'").join(kids, "submission_item", "left")
    post = F.struct(
        F.substring("item_id", 4, 1 << 30).alias("id"), F.col("item_id").alias("name"), "subreddit", "title", "selftext", F.col("created_s").cast("double").alias("created_utc"), "score", F.lit(1.0).alias("upvote_ratio"), F.lit(0).alias("num_comments"), "permalink", F.lit("u").alias("url"),
        F.col("is_self").cast("boolean").alias("is_self"), F.lit(False).alias("over_18"), F.lit(False).alias("spoiler"), F.lit(False).alias("stickied"), F.lit(False).alias("locked"), F.lit(False).alias("archived"), F.lit(0).alias("num_crossposts"), F.lit("a").alias("author"), "comments",
    )
    return posts.select(F.lit("1").alias("schema_version"), F.array(post).alias("submissions"))  # one file object a post


def _fixture(s: SparkSession, d: str) -> DataFrame:
    at = folder(s)
    _fixture_rows(s, d).write.json(f"{at}/fixture")
    rows = s.read.schema(files.FIXTURE).json(f"{at}/fixture").select("submissions", F.monotonically_increasing_id().alias("file"))
    posts = rows.select("file", F.posexplode("submissions").alias("n", "p"))
    posts = posts.withColumn("post_no", F.col("p.name"))
    a = posts.select("post_no", F.lit("submission").alias("record_type"), "p.*").drop("comments")
    b = posts.select("post_no", F.explode("p.comments").alias("c")).select("post_no", F.lit("comment").alias("record_type"), "c.*")
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT item_id, list_filter([CASE WHEN record_type = 'comment' AND score % 7 = 0 THEN 'missing author' END, CASE WHEN record_type = 'comment' AND score % 13 = 0 THEN 'subreddit differs from the post''s' END], lambda x: x IS NOT NULL) AS errors FROM corpus", "corpus")
def s04_fixture_errors(s: SparkSession, d: str) -> DataFrame:
    """Nested posts and comments, each with what is wrong with it."""
    got = files.fixture_errors(_fixture(s, d))
    known = F.filter("errors", lambda e: e.isin("missing author", "subreddit differs from the post's"))
    return got.select(F.col("name").alias("item_id"), known.alias("errors"))


@query("SELECT event_id AS id, event_type AS subreddit, CAST(ts AS DATE)::VARCHAR AS day FROM events WHERE event_type IN ('click', 'view') AND CAST(ts AS DATE) BETWEEN (SELECT min(CAST(ts AS DATE)) + 1 FROM events) AND (SELECT min(CAST(ts AS DATE)) + 5 FROM events)")
def s05_archive(s: SparkSession, d: str) -> DataFrame:
    """Files by feed and day, pages that overlap; only the asked feeds and days are read."""
    at, e = folder(s), s.read.parquet(f"{d}/events.parquet")
    rows = e.select(F.col("event_id").alias("id"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("created_utc"), F.col("event_type").alias("subreddit"), F.to_date("ts").cast("string").alias("day"))
    rows.unionByName(rows.filter("id % 4 = 0")).write.partitionBy("subreddit", "day").json(f"{at}/archive")
    first = e.agg(F.min(F.to_date("ts")).alias("m")).select(F.date_add("m", 1).cast("string"), F.date_add("m", 5).cast("string")).first()
    return files.archive(s, f"{at}/archive", ["click", "view"], *first).select("id", "subreddit", F.col("day").cast("string").alias("day"))


def _pages(s: SparkSession, d: str) -> DataFrame:
    """Listing pages of twenty posts as JSON text, some children of another kind, some without an id."""
    c = view(s, d, "corpus").filter("record_type = 'submission'").withColumn("conv", F.substring_index(F.substring("item_id", 4, 99), "_", 1).cast("long"))
    child = F.struct(F.when(F.col("conv") % 9 == 0, "t5").otherwise("t3").alias("kind"), F.struct(F.when(F.col("conv") % 11 != 0, F.substring("item_id", 4, 99)).otherwise("").alias("id"), F.col("item_id").alias("name"), "subreddit", "title", "selftext", F.col("created_s").cast("double").alias("created_utc"), "score", "permalink", "author", F.col("is_self").cast("boolean").alias("is_self")).alias("data"))
    return c.groupBy(F.floor(F.col("conv") / 20).alias("page_no")).agg(F.to_json(F.struct(F.struct(F.lit("t3_x").alias("after"), F.transform(F.array_sort(F.collect_list(F.struct("conv", child.alias("c")))), lambda x: x["c"]).alias("children")).alias("data"))).alias("value"))


_CONV = "split_part(substring(item_id, 4), '_', 1)::BIGINT"


@query(f"SELECT {_CONV} // 20 AS page_no, item_id AS name, subreddit, score, coalesce(is_self <> 0, false) AS is_self FROM corpus WHERE record_type = 'submission' AND {_CONV} % 9 <> 0 AND {_CONV} % 11 <> 0", "corpus")
def s07_listing(s: SparkSession, d: str) -> DataFrame:
    """Posts of listing pages."""
    return markup.listing(_pages(s, d)).select("page_no", "name", "subreddit", "score", F.coalesce("is_self", F.lit(False)).alias("is_self"))


@query(
    "SELECT submission_item AS post, substring(item_id, 4) AS id, parent_item AS parent_id, (CASE WHEN parent_item = submission_item THEN 0 WHEN depth = 1 THEN 1 ELSE 2 END)::INT AS depth, 2::INT AS more FROM corpus WHERE record_type = 'comment' AND (parent_item = submission_item OR depth = 1)",
    "corpus",
)
def s08_comment_tree(s: SparkSession, d: str) -> DataFrame:
    """Nested replies, parents first; two levels of the corpus and a node that says how many more there are."""
    c = view(s, d, "corpus").filter("record_type = 'comment'")
    data = lambda replies: F.struct(F.substring("item_id", 4, 99).alias("id"), F.col("parent_item").alias("parent_id"), "body", F.col("created_s").cast("double").alias("created_utc"), replies.alias("replies"))
    leaf = F.struct(F.lit("t1").alias("kind"), data(F.lit("")).alias("data"))
    low = c.filter("depth = 1").groupBy(F.col("parent_item").alias("up")).agg(F.array_sort(F.collect_list(leaf)).alias("kids"))
    top = c.filter("parent_item = submission_item").join(low, F.col("item_id") == F.col("up"), "left")
    node = F.struct(F.lit("t1").alias("kind"), data(F.struct(F.struct(F.col("kids").alias("children")).alias("data"))).alias("data"))
    pages = top.groupBy(F.col("submission_item").alias("post")).agg(F.to_json(F.collect_list(node)).alias("nodes"))
    more = '{"kind": "more", "data": {"count": 2}}'
    value = F.concat(F.lit('[{}, {"data": {"children": [' + more + ", "), F.expr("substring(nodes, 2, length(nodes) - 2)"), F.lit("]}}]"))
    return markup.comment_tree(pages.select("post", value.alias("value"))).select("post", "id", "parent_id", "depth", "more")


def _html(s: SparkSession, d: str) -> DataFrame:
    """A page a post with its elements, promoted ones among them."""
    c = view(s, d, "corpus").withColumn("conv", F.substring_index(F.substring("item_id", 4, 99), "_", 1).cast("long"))
    esc = lambda x: text.escape_html(F.coalesce(x, F.lit("")))
    body = F.concat(F.lit('<div id="x-post-rtjson-content"><p>'), esc(F.translate(F.coalesce("selftext", "body", F.lit("")), "\n\r", "  ")), F.lit("</p></div><div id=\"y-post-rtjson-content\">other</div>"))
    post = F.concat(F.lit('<shreddit-post id="'), F.col("item_id"), F.lit('" subreddit-name="'), F.col("subreddit"), F.lit('" score="'), F.col("score").cast("string"), F.lit('" post-type="'), F.when(F.col("is_self") == 1, "text").otherwise("link"), F.lit('" created-timestamp="'), _iso(), F.lit('" '), F.when(F.col("conv") % 6 == 0, "promoted").otherwise("nsfw"), F.lit(">"), body, F.lit("</shreddit-post>"))
    comment = F.concat(F.lit('<shreddit-comment thingid="'), F.col("item_id"), F.lit('" postid="'), F.col("submission_item"), F.lit('" depth="'), F.coalesce(F.col("depth").cast("string"), F.lit("")), F.lit('" created="'), _iso(), F.lit('"'), F.when(F.col("parent_item") != F.col("submission_item"), F.concat(F.lit(' parentid="'), F.substring("parent_item", 4, 99), F.lit('"'))).otherwise(""), F.when(F.col("is_submitter") == 1, " is-op").otherwise(""), F.lit(">"), body, F.lit("</shreddit-comment>"))
    one = c.select(F.col("submission_item").alias("page_id"), F.struct((F.col("record_type") != "submission").alias("k"), "item_id", F.when(F.col("record_type") == "submission", post).otherwise(comment).alias("h")).alias("e"))
    return one.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["h"]), "").alias("html"))


_BODY = "trim(translate({0}, chr(10) || chr(13), '  '))".format


@query(f"SELECT item_id AS name, subreddit, score::BIGINT AS score, coalesce(is_self = 1, false) AS is_self, true AS over_18, epoch_us(to_timestamp(created_s))::BIGINT AS us, CASE WHEN {_BODY('selftext')} = '' THEN 'other' ELSE {_BODY('selftext')} END AS selftext, '/r/' || subreddit || '/comments/' || substring(item_id, 4) || '/' AS permalink FROM corpus WHERE record_type = 'submission' AND {_CONV} % 6 <> 0", "corpus")
def s10_page_posts(s: SparkSession, d: str) -> DataFrame:
    """Post elements of pages; promoted ones are out, the first body that is not empty counts."""
    got = markup.posts(markup.elements(_html(s, d)))
    return got.select("name", "subreddit", F.col("score").cast("long").alias("score"), "is_self", "over_18", F.unix_micros("created_utc").alias("us"), F.trim("selftext").alias("selftext"), "permalink")


@query(f"SELECT item_id AS name, submission_item AS link_id, CASE WHEN parent_item = submission_item THEN submission_item ELSE 't1_' || substring(parent_item, 4) END AS parent_id, coalesce(depth, 0)::INT AS depth, coalesce(is_submitter = 1, false) AS is_submitter, {_BODY('body')} AS body FROM corpus WHERE record_type = 'comment'", "corpus")
def s11_page_comments(s: SparkSession, d: str) -> DataFrame:
    """Comment elements; the parent defaults to the post."""
    return markup.comments(markup.elements(_html(s, d)), "subx").select("name", "link_id", "parent_id", "depth", "is_submitter", F.trim("body").alias("body"))


def _snapshots(s: SparkSession, d: str) -> DataFrame:
    c = view(s, d, "corpus").filter("record_type = 'submission'").withColumn("conv", F.substring_index(F.substring("item_id", 4, 99), "_", 1).cast("long"))
    seen = c.withColumn("snapshot_no", F.explode(F.array(F.floor(F.col("conv") / 10), F.floor(F.col("conv") / 10) + 1)))
    return seen.select(F.col("item_id").alias("id"), "snapshot_no", F.col("conv").alias("pos"), (F.col("conv") % 7 == 0).alias("promoted"), F.when(F.col("conv") % 5 == 0, "").otherwise(F.col("permalink")).alias("permalink"))


@query(f"SELECT item_id AS id, {_CONV} // 10 AS snapshot_no FROM corpus WHERE record_type = 'submission' AND {_CONV} % 7 <> 0 AND {_CONV} % 5 <> 0", "corpus")
def s14_cards(s: SparkSession, d: str) -> DataFrame:
    """Listing cards seen in several snapshots, each once, where it was first."""
    return files.cards(_snapshots(s, d)).select("id", "snapshot_no")


@query("SELECT item_id AS id, CASE WHEN score % 2 = 0 THEN 'listing' ELSE 'page' END AS origin FROM corpus WHERE record_type = 'comment'", "corpus")
def s15_merged(s: SparkSession, d: str) -> DataFrame:
    """The listing's row where both have one."""
    c = view(s, d, "corpus").filter("record_type = 'comment'").select(F.col("item_id").alias("id"), F.col("created_s").alias("pos"), "score")
    return files.merged(c.filter("score % 2 = 0").withColumn("origin", F.lit("listing")), c.withColumn("origin", F.lit("page"))).select("id", "origin")


@query(
    "SELECT c.item_id AS id FROM corpus c LEFT JOIN (SELECT submission_item AS l, count(*) AS n FROM corpus WHERE record_type = 'comment' AND score % 2 = 0 GROUP BY 1) h ON h.l = c.submission_item LEFT JOIN (SELECT submission_item AS l, count(*) AS n FROM corpus WHERE record_type = 'comment' GROUP BY 1) a ON a.l = c.submission_item "
    "WHERE record_type = 'comment' AND (score % 2 = 0 OR h.n IS NULL OR a.n > h.n + 2)",
    "corpus",
)
def s22_topped_up(s: SparkSession, d: str) -> DataFrame:
    """Comments of the page only for posts whose listing lacks too many."""
    c = view(s, d, "corpus").filter("record_type = 'comment'").select(F.col("item_id").alias("id"), F.col("submission_item").alias("link_id"), F.col("created_s").alias("pos"), "score")
    posts = c.groupBy("link_id").agg(F.count("*").alias("listed")).withColumn("truncated", F.lit(False))
    return files.topped_up(c.filter("score % 2 = 0"), c, posts).select("id")


def _suggestions(s: SparkSession, d: str) -> DataFrame:
    """A suggestion for each document, its span the second half of the text, or no part of it."""
    docs = s.read.parquet(f"{d}/documents.parquet")
    half = F.substring("text", F.floor(F.length("text") / 2).cast("int") + 1, F.length("text"))
    span = F.when(F.col("doc_id") % 3 == 0, F.lit("~~ no such words ~~")).when(F.col("doc_id") % 3 == 1, half)
    name, sure = F.concat(F.lit("d"), F.col("doc_id").cast("string")), (F.col("doc_id") % 23) / F.lit(20.0)
    return docs.select("doc_id", name.alias("item_id"), sure.alias("confidence"), span.alias("sarcastic_span"), "text")


_ERRORS = """SELECT 'd' || doc_id AS item_id, list_filter([CASE WHEN gone THEN 'not in the corpus' END, CASE WHEN doc_id % 23 > 20 THEN 'confidence outside 0 to 1' END,
  CASE WHEN doc_id % 3 = 0 OR doc_id % 3 = 1 AND gone AND len(text) > 0 THEN 'span is no part of the text' END], lambda x: x IS NOT NULL) AS errors FROM (SELECT *, doc_id % 31 = 0 OR text IS NULL AS gone FROM documents) x"""


@query(_ERRORS)
def s16_assist_errors(s: SparkSession, d: str) -> DataFrame:
    """S16, over whole texts."""
    rows = _suggestions(s, d)
    return review.assist_errors(rows.drop("text", "doc_id"), rows.filter("doc_id % 31 <> 0").select("item_id", "text")).select("item_id", "errors")


@query(
    "SELECT count(*) AS lines, count(*) FILTER (WHERE len(errors) = 0) AS fine, count(*) FILTER (WHERE len(errors) > 0) AS wrong, CASE WHEN count(*) FILTER (WHERE len(errors) > 0) = 0 THEN count(*) ELSE 0 END AS stored FROM e",
    e=_ERRORS,
)
def a29_assist_counts(s: SparkSession, d: str) -> DataFrame:
    """Nothing is stored if anything is wrong."""
    rows = _suggestions(s, d)
    return review.assist_counts(review.assist_errors(rows.drop("text", "doc_id"), rows.filter("doc_id % 31 <> 0").select("item_id", "text")))


@query("SELECT DISTINCT 'd' || (doc_id % 97) AS item_id FROM documents WHERE doc_id % 5 <> 0")
def s17_id_list(s: SparkSession, d: str) -> DataFrame:
    """A list with comments, blanks and repeats."""
    at, docs = folder(s), s.read.parquet(f"{d}/documents.parquet").select("doc_id")
    name = F.concat(F.lit("d"), (F.col("doc_id") % 97).cast("string"))
    line = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("# "), name)).when(F.col("doc_id") % 5 == 1, F.concat(F.lit("  "), name, F.lit("   # why"))).otherwise(name)
    docs.select(line.alias("value")).unionByName(docs.filter("doc_id % 9 = 0").select(F.lit("   ").alias("value"))).write.text(f"{at}/ids")
    return files.id_list(s, f"{at}/ids").select("item_id")


def _manifests(s: SparkSession, d: str) -> DataFrame:
    at, docs = folder(s), s.read.parquet(f"{d}/documents.parquet")
    rows = docs.select(
        F.concat(F.lit("run-"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("collection_run_id"), F.when(F.col("doc_id") % 2 == 0, "archive").otherwise("live").alias("source"),
        F.concat(F.lit("2026-11-"), F.lpad((1 + F.col("doc_id") % 28).cast("string"), 2, "0")).alias("started_at_utc"), F.col("n_chars").cast("long").alias("submissions_stored"), (F.col("doc_id") % 100).alias("comments_stored"),
    )
    files.write_manifest(rows, f"{at}/manifests")  # a run is a line
    s.createDataFrame([("{ not json",)], "value string").write.mode("append").text(f"{at}/manifests")
    return s.read.schema(files.MANIFEST).json(f"{at}/manifests").filter("collection_run_id IS NOT NULL")


_RUNS = "SELECT 'run-' || lpad(doc_id::VARCHAR, 9, '0') AS id, CASE WHEN doc_id % 2 = 0 THEN 'archive' ELSE 'live' END AS source, '2026-11-' || lpad((1 + doc_id % 28)::VARCHAR, 2, '0') AS started, n_chars, doc_id % 100 AS comments FROM documents"


@query("SELECT substring(id, 1, 8) || '…' AS run, source, started AS started_at_utc FROM r", r=_RUNS)
def p19_runs(s: SparkSession, d: str) -> DataFrame:
    """Runs for display, the newest first; unreadable lines leave none."""
    return views.runs(_manifests(s, d)).select("run", "source", "started_at_utc")


@query("SELECT 'archive' AS kind, count(*) AS runs, coalesce(sum(n_chars), 0)::BIGINT AS posts, coalesce(sum(comments), 0)::BIGINT AS comments FROM r WHERE source = 'archive' UNION ALL SELECT 'live', count(*), coalesce(sum(n_chars), 0)::BIGINT, coalesce(sum(comments), 0)::BIGINT FROM r WHERE source = 'live' AND started >= '2026-11-08'", r=_RUNS)
def a24_run_totals(s: SparkSession, d: str) -> DataFrame:
    m = _manifests(s, d)
    return files.run_totals(m, "archive").withColumn("kind", F.lit("archive")).unionByName(files.run_totals(m, "live", "2026-11-08").withColumn("kind", F.lit("live")))


@query("SELECT doc_id AS n FROM documents ORDER BY doc_id DESC LIMIT 10")
def s19_newest_tail(s: SparkSession, d: str) -> DataFrame:
    """The tail's length is the operator's own limit."""
    at = folder(s)
    s.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").cast("string").alias("value")).coalesce(1).write.text(f"{at}/lines/old")
    s.read.parquet(f"{d}/documents.parquet").select("doc_id").orderBy("doc_id").select(F.col("doc_id").cast("string").alias("value")).coalesce(1).write.text(f"{at}/lines/new")
    return lines.tail(s, f"{at}/lines", 10).select(F.col("value").cast("long").alias("n"))


_EP = "SELECT page_id, page_id % 6 AS shape, split_part(split_part(url, '://', 2), '/', 1) AS host, 8000 + page_id % 50 AS port FROM pages"


@query(
    "SELECT page_id AS line_no, shape <> 5 AS ok, CASE WHEN shape <> 5 THEN host END AS host, CASE WHEN shape <> 5 THEN port END::INT AS port, CASE WHEN shape = 0 THEN 'socks5' WHEN shape <> 5 THEN 'http' END AS scheme, CASE WHEN shape IN (1, 2, 3) THEN 'me' END AS \"user\", "
    "shape <> 5 AND row_number() OVER (PARTITION BY shape = 5, shape = 0, shape IN (1, 2, 3), host, port ORDER BY page_id) > 1 AS repeated FROM e",
    e=_EP,
)
def s20_endpoints(s: SparkSession, d: str) -> DataFrame:
    """Six shapes of line, repeats and wrong ones marked."""
    p = s.read.parquet(f"{d}/pages.parquet").select("page_id", F.parse_url("url", F.lit("HOST")).alias("h"), (8000 + F.col("page_id") % 50).cast("string").alias("n"))
    at = F.concat_ws(":", "h", "n")
    shapes = [F.concat(F.lit("socks5://"), at), F.concat(F.lit("me:pw@"), at), F.concat(at, F.lit(":me:pw")), F.concat(F.lit("me:pw:"), at), at, F.concat(F.lit("port "), at)]
    value = F.element_at(F.array(*shapes), (F.col("page_id") % 6 + 1).cast("int"))
    return files.endpoints(p.select(F.col("page_id").alias("line_no"), value.alias("value"))).select("line_no", "ok", "host", "port", "scheme", "user", "repeated")


@query(
    """WITH f AS (SELECT *, score % 5 AS file FROM corpus), now AS (SELECT * FROM f WHERE file <> 1 AND NOT (file = 2 AND record_type = 'submission') UNION ALL SELECT *, 9 FROM corpus WHERE score % 10 = 1)
    SELECT subreddit, count(*) FILTER (WHERE record_type = 'submission') AS submissions, count(*) FILTER (WHERE record_type = 'comment') AS comments, max(created_s)::BIGINT AS last_seen, 3 AS files_read
    FROM (SELECT DISTINCT item_id, subreddit, record_type, created_s FROM now) x GROUP BY subreddit""".replace("WITH f AS", "SELECT * FROM (WITH f AS")
    + ") y",
    "corpus",
)
def z09_changed_files(s: SparkSession, d: str) -> DataFrame:
    """Counts after files came, went and changed, of which only these were read: one is gone, one has lost its posts, one is new, the others stay."""
    at, r = folder(s), _records(s, d)
    put = lambda n, rows: rows.coalesce(1).write.mode("overwrite").json(f"{at}/raw/{n}")
    for n in range(5):
        put(n, r.filter(f"score % 5 = {n}"))
    index = indexed.FileIndex(s, f"{at}/raw", f"{at}/index")
    index.refresh()
    fs, gone = hadoop(s, f"{at}/raw/1")
    fs.delete(gone, True)
    put(2, r.filter("score % 5 = 2 AND record_type = 'comment'"))
    put(9, r.filter("score % 10 = 1"))
    done = index.refresh()
    return corpus.subreddit_stats(index.items()).withColumn("files_read", F.lit(len(done["read"]) + len({f.split("/")[-2] for f in done["gone"]} - {"2"})))


# --- whole export rows ---------------------------------------------------------------------------------------------------

_FOUR = ("polarity_inversion", "rhetorical_intent", "contextual_incongruity", "hyperbole")
_FLAG = "coalesce({}, 0)::INT".format
_SAID = (
    "concat_ws('|', {p}model_key, coalesce({p}sarcastic::VARCHAR, '-'), {p}language, {p}literal_sentiment, {p}intended_sentiment, "
    + ", ".join("coalesce({p}cue_" + c + ", 0)" for c in _FOUR) + ", coalesce(round({p}confidence * 100)::INT::VARCHAR, '-'), {p}rationale)"
)
_CUES_SQL = ", ".join(_FLAG(f"cue_{c}_final") for c in _FOUR)
_FIRST = "json_extract_string(first_pass_json, '$.{}')".format
_P12_SQL = f""", {_EXP},
lid AS ({ORACLES["u01_language"]}),
per AS ({ORACLES["a16_per_label_resolution"]}),
said AS (SELECT item_id, string_agg({_SAID.format(p="")}, ';' ORDER BY model_key) AS annotators FROM lineup GROUP BY item_id),
adj AS (SELECT item_id, {_SAID.format(p="")} AS adjudicator FROM ratings WHERE role = 'adjudicator'),
gold AS (SELECT item_id, concat_ws('|', sarcastic, language, literal_sentiment, intended_sentiment, {", ".join(_FLAG(f"cue_{c}") for c in _FOUR)},
  CASE WHEN first_pass_json IS NULL THEN 'none' ELSE concat_ws('/', {_FIRST("sarcastic")}, {_FIRST("language")}, {_FIRST("literal_sentiment")}, {_FIRST("intended_sentiment")}, 0, 0, 0, 0) END, 'false', (votes_seen <> 0)::VARCHAR) AS gold
  FROM reviews WHERE is_gold <> 0)
SELECT x.item_id, 'comment' AS record_type, x.source AS subreddit, c.text, true AS is_text_only, sarcastic_final::BOOLEAN AS sarcastic, majority AS sarcastic_majority, round(yes / n, 4) AS sarcasm_vote_share, language_final AS language,
  literal_final AS literal_sentiment, intended_final AS intended_sentiment, concat_ws('|', {_CUES_SQL}) AS cues, resolved_by, concat_ws('|', per.sarcastic, per.language, per.literal_sentiment, per.intended_sentiment) AS per_label,
  sarcasm_votes, n_annotators::INT AS n_annotators, mean_confidence, needs_human <> 0 AS needs_human, said.annotators, adj.adjudicator, gold.gold,
  concat_ws('|', lid.language, lid.language, lid.en_ratio, lid.tl_ratio, lid.other_ratio) AS lid, 'missing' AS context, c.phatic, 'v3|d1' AS provenance
FROM exported x JOIN candidates c ON c.item_id = x.item_id LEFT JOIN lid ON 'd' || lid.doc_id = x.item_id LEFT JOIN per ON per.item_id = x.item_id LEFT JOIN said ON said.item_id = x.item_id
LEFT JOIN adj ON adj.item_id = x.item_id LEFT JOIN gold ON gold.item_id = x.item_id"""


@query(_with(_P12_SQL, _AGG, "candidates"))
def p12_export_rows(s: SparkSession, d: str) -> DataFrame:
    """The nested rows whole, their inner structs written out."""
    e = _exported(s, d)
    bit = lambda x: F.coalesce(x.cast("int"), F.lit(0)).cast("string")
    named = lambda v: [v["language"], v["literal_sentiment"], v["intended_sentiment"], *(bit(v["cues"][c]) for c in _FOUR)]
    said = lambda v: F.concat_ws("|", v["model_key"], F.coalesce(v["sarcastic"].cast("int").cast("string"), F.lit("-")), *named(v), F.coalesce(F.round(v["confidence"] * 100).cast("int").cast("string"), F.lit("-")), v["rationale"])
    g, f, r, lid = F.col("human_gold"), F.col("human_gold.first_pass"), F.col("reliability"), F.col("aux.lid")
    first = F.when(f.isNull(), F.lit("none")).otherwise(F.concat_ws("/", f["sarcastic"].cast("int").cast("string"), *named(f)))
    gold = F.concat_ws("|", g["sarcastic"].cast("int").cast("string"), *named(g), first, g["assist_seen"].cast("string"), g["votes_seen"].cast("string"))
    return e.select(
        "item_id", "record_type", "subreddit", "text", "is_text_only", "labels.sarcastic", "labels.sarcastic_majority", "labels.sarcasm_vote_share", "labels.language", "labels.literal_sentiment", "labels.intended_sentiment",
        F.concat_ws("|", *(bit(F.col(f"labels.cues.{c}")) for c in _FOUR)).alias("cues"), r["resolved_by"].alias("resolved_by"), F.concat_ws("|", *(r["per_label"][k] for k in ("sarcastic", "language", "literal_sentiment", "intended_sentiment"))).alias("per_label"),
        r["sarcasm_votes"].alias("sarcasm_votes"), r["n_annotators"].cast("int").alias("n_annotators"), r["mean_confidence"].alias("mean_confidence"), r["needs_human"].alias("needs_human"),
        F.array_join(F.transform(r["annotators"], said), ";").alias("annotators"), F.when(r["adjudicator"].isNotNull(), said(r["adjudicator"])).alias("adjudicator"), F.when(g.isNotNull(), gold).alias("gold"),
        F.concat_ws("|", lid["auto_label"], lid["language"], *(text.ratio(lid[c]) for c in ("en_ratio", "tl_ratio", "other_ratio"))).alias("lid"), "context.source", "flags.phatic", F.concat_ws("|", "provenance.prompt_version", "provenance.dataset_version").alias("provenance"),
    ).withColumnRenamed("source", "context")


# --- sinks ---------------------------------------------------------------------------------------------------------------

_OUT = "SELECT item_id, language_final AS language, resolved_by, source AS subreddit FROM exported"


def _agg_sql(select: str, *more: str) -> tuple[str]:
    return (_with(select, _AGG, *more),)


def _exp_sql(select: str) -> tuple[str]:
    return _agg_sql(f", {_EXP} {select}", "candidates")


@query(*_exp_sql(_OUT))
def k03_json_rows(s: SparkSession, d: str) -> DataFrame:
    """The nested rows, written as JSON lines and read back."""
    at, rows = folder(s), _exported(s, d)
    rows.write.json(f"{at}/dataset")
    return s.read.schema(rows.schema).json(f"{at}/dataset").select("item_id", "labels.language", "reliability.resolved_by", "subreddit")


@query(*_exp_sql("SELECT item_id, language_final AS label_language, sarcastic_final::BOOLEAN AS label_sarcastic, {'phatic': FALSE} IS NOT NULL AS has_flags, source AS subreddit FROM exported"))
def k04_flat_rows(s: SparkSession, d: str) -> DataFrame:
    """The flat rows as Parquet; nested parts are JSON text."""
    at = folder(s)
    export.flat(_exported(s, d)).write.parquet(f"{at}/flat")
    return s.read.parquet(f"{at}/flat").select("item_id", "label_language", "label_sarcastic", F.get_json_object("flags_json", "$.phatic").isNotNull().alias("has_flags"), "subreddit")


@query(*_exp_sql("SELECT 'd1' AS dataset_version, 'v3' AS prompt_version, count(*) AS exported_rows, count(CASE WHEN language_final = 'english' THEN 1 END) AS english, (SELECT count(*) FROM ratings) AS votes FROM exported"))
def k06_card(s: SparkSession, d: str) -> DataFrame:
    """The card's document, written under its two names and read back."""
    at, ratings = folder(s), view(s, d, "ratings")
    c = view(s, d, "candidates").select("item_id", F.lit("comment").alias("record_type"))
    doc = export.card(_exported(s, d), c, ratings, view(s, d, "candidates"), "d1", VERSION, "2026-11-26T00:00:00Z")
    export.write_card(s, f"{at}/out", doc)
    got = s.read.option("multiLine", "true").schema("dataset_version string, prompt_version string, counts struct<exported_rows: bigint>, label_distributions struct<language: struct<english: bigint>>, annotator_provenance array<struct<n: bigint>>").json(f"{at}/out/dataset_card-d1.json")
    return got.select("dataset_version", "prompt_version", "counts.exported_rows", F.coalesce("label_distributions.language.english", F.lit(0)).alias("english"), F.aggregate("annotator_provenance", F.lit(0).cast("bigint"), lambda a, x: a + x["n"]).alias("votes"))


@query("SELECT 'dataset-d1.zip' AS newest, true AS verified, count(*) AS lines FROM documents")
def k07_bundle(s: SparkSession, d: str) -> DataFrame:
    """A zip with its checksums, found again as the newest; the sums hold for what is in it."""
    import hashlib
    import io
    import zipfile

    at, docs = folder(s), s.read.parquet(f"{d}/documents.parquet").select("doc_id")
    docs.write.json(f"{at}/set/rows")
    export.put(s, f"{at}/zips", "other.zip", b"")
    export.bundle(s, f"{at}/set", f"{at}/zips", "d1")
    path = export.newest_bundle(s, f"{at}/zips")
    raw = s.read.format("binaryFile").load(path).select("content").first()[0]
    with zipfile.ZipFile(io.BytesIO(bytes(raw))) as z:
        sums = dict(reversed(line.split("  ", 1)) for line in z.read("SHA256SUMS.txt").decode().splitlines())
        fine = all(hashlib.sha256(z.read(n)).hexdigest() == x for n, x in sums.items())
        lines = sum(z.read(n).count(b"\n") for n in sums if n.endswith(".json"))
    return s.createDataFrame([(path.rsplit("/", 1)[-1], fine, lines)], "newest string, verified boolean, lines bigint")


@query("SELECT event_id AS n, event_type AS t FROM events")
def k08_csv(s: SparkSession, d: str) -> DataFrame:
    """Written with a header, read back."""
    at, e = folder(s), s.read.parquet(f"{d}/events.parquet").select(F.col("event_id").alias("n"), F.col("event_type").alias("t"))
    files.write_csv(e, f"{at}/csv")
    return s.read.option("header", "true").schema(e.schema).csv(f"{at}/csv")


@query(
    "SELECT CASE WHEN tagged THEN '{\"doc_id\": ' || doc_id || ', \"sampling_strategy\": \"natural\", \"matched_query_or_keyword\": null}' ELSE line END || CASE WHEN doc_id % 2 = 0 THEN '\\r' ELSE '' END AS line "
    "FROM (SELECT doc_id, doc_id % 4 = 0 AS tagged, '{\"doc_id\":  ' || doc_id || ', \"sampling_strategy\": \"' || CASE WHEN doc_id % 4 < 2 THEN 'keyword_oversampled' ELSE 'natural' END || '\", \"matched_query_or_keyword\":\"' || CASE WHEN doc_id % 4 = 0 THEN '2026-06-01' ELSE 'edi wow' END || '\"}' AS line FROM documents) x".replace("'\\r'", "chr(13)")
)
def k10_rewrite(s: SparkSession, d: str) -> DataFrame:
    """Files of JSON lines rewritten in place; what isn't changed stays byte for byte, odd blanks and line ends included."""
    at, docs = folder(s), s.read.parquet(f"{d}/documents.parquet")
    kind = F.when(F.col("doc_id") % 4 < 2, "keyword_oversampled").otherwise("natural")
    word = F.when(F.col("doc_id") % 4 == 0, "2026-06-01").otherwise("edi wow")
    line = F.format_string('{"doc_id":  %d, "sampling_strategy": "%s", "matched_query_or_keyword":"%s"}%s', "doc_id", kind, word, F.when(F.col("doc_id") % 2 == 0, "\r").otherwise(""))
    docs.select(line.alias("value")).write.option("lineSep", "\n").text(f"{at}/raw")
    for file, _, _ in listed(s, f"{at}/raw"):  # Spark names them .txt
        fs, path = hadoop(s, file)
        fs.rename(path, hadoop(s, file.removesuffix(".txt") + ".jsonl")[1])
    lines.rewrite(s, f"{at}/raw", lines.edited(lines.lines(s, f"{at}/raw"), lines.retagged))
    return s.read.option("lineSep", "\n").text(f"{at}/raw").select(F.col("value").alias("line"))


# --- threads, review, states -----------------------------------------------------------------------------------------------

#: Chains made of the events in their order: every fourth 620 of them are one chain, the others chains of 31. Of the short ones every
#: fifth lacks its post, every other fifth its first comment.
_DEEP = """
SELECT CASE WHEN i = 0 THEN 't3_' || c ELSE 't1_' || c || '_' || CAST(i AS STRING) END AS item_id, CASE WHEN i = 0 THEN 'submission' ELSE 'comment' END AS record_type, 's' AS subreddit,
  't3_' || c AS submission_item, CASE WHEN i = 1 THEN 't3_' || c WHEN i > 1 THEN 't1_' || c || '_' || CAST(i - 1 AS STRING) END AS parent_item,
  CAST(CASE WHEN i > 0 THEN i - 1 END AS INT) AS depth, 1000 + i AS created_s, CAST(event_id AS STRING) AS author_hash, 'pseudonymized' AS author_status, CAST(i % 2 AS INT) AS is_submitter,
  CASE WHEN i = 0 THEN event_type || ' post' END AS title, CAST(NULL AS STRING) AS selftext, event_type || CAST(event_id AS STRING) AS body, event_type || CAST(event_id AS STRING) AS text, '/p' AS permalink
FROM (SELECT event_id, event_type, CASE WHEN b % 4 = 0 THEN 'd' || CAST(b AS STRING) ELSE 's' || CAST(k AS STRING) END AS c,
    CASE WHEN b % 4 = 0 THEN event_id % 620 ELSE event_id % 31 END AS i, CASE WHEN b % 4 = 0 THEN 0 ELSE k % 5 END AS kind
  FROM (SELECT event_id, event_type, CAST(floor(event_id / 620) AS BIGINT) AS b, CAST(floor(event_id / 31) AS BIGINT) AS k FROM {events}) x) y
WHERE NOT (kind = 3 AND i = 0) AND NOT (kind = 4 AND i = 1)
"""
_DEEP_SQL = _DEEP.replace("{events}", "events")
#: Comments that are missing their chain's first one.
_CUT = "(record_type = 'comment' AND submission_item LIKE 't3_s%' AND substring(submission_item, 5)::BIGINT % 5 = 4)"


def _deep(s: SparkSession, d: str) -> DataFrame:
    return s.sql(_DEEP, events=s.read.parquet(f"{d}/events.parquet"))


@query("SELECT item_id, least(CASE WHEN x THEN depth ELSE depth END, 500)::INT AS depth_found FROM (SELECT *, true AS x FROM deep) y WHERE record_type = 'comment'", deep=_DEEP_SQL)
def g02_deep(s: SparkSession, d: str) -> DataFrame:
    """G02 to its 500 hops."""
    return threads.depths(_deep(s, d)).select("item_id", F.col("depth_found").cast("int").alias("depth_found"))


@query(
    "SELECT item_id, n::INT AS n, CASE WHEN n > 0 THEN 't1_' || substring(submission_item, 4) || '_' || (depth + 1 - n) END AS first_one, CASE WHEN n > 0 THEN parent_text END AS last_text "
    f"FROM (SELECT q.*, p.text AS parent_text, CASE WHEN q.record_type = 'submission' THEN 0 WHEN {_CUT.replace('record_type', 'q.record_type').replace('submission_item', 'q.submission_item')} THEN least(q.depth - 1, 50) ELSE least(q.depth, 50) END AS n "
    "FROM deep q LEFT JOIN deep p ON p.item_id = q.parent_item) z",
    deep=_DEEP_SQL,
)
def g01_deep(s: SparkSession, d: str) -> DataFrame:
    """G01, G06, J16 to 50 ancestors, the root side first."""
    a = threads.ancestors(_deep(s, d), threads.ANCESTORS)
    first, last = F.try_element_at("chain", F.lit(1)), F.try_element_at("chain", F.lit(-1))
    return a.select("item_id", F.size("chain").alias("n"), first["item_id"].alias("first_one"), last["text"].alias("last_text"))


@query(
    "SELECT submission_item AS thread, item_id, CASE WHEN record_type = 'submission' THEN 'POST [' || substring(item_id, 4) || '] ' || title "
    "ELSE repeat('  ', (created_s - 1000)::INT) || '└ [comment ' || substring(item_id, 4) || '] u/' || author_hash || '  ' || body END AS line "
    f"FROM deep WHERE NOT {_CUT} UNION ALL SELECT DISTINCT submission_item, submission_item, 'POST [' || substring(submission_item, 4) || ']' FROM deep WHERE submission_item LIKE 't3_s%' AND substring(submission_item, 5)::BIGINT % 5 = 3",
    deep=_DEEP_SQL,
)
def g03_rendered(s: SparkSession, d: str) -> DataFrame:
    """Threads as text, however deep; posts that were not collected head their replies."""
    return threads.rendered(_deep(s, d)).select("thread", "item_id", "line")


@query("SELECT g.item_id, CASE WHEN c.score % 8 = 0 THEN 'stored for ' || g.item_id ELSE g.context_text END AS context_text FROM g JOIN corpus c ON c.item_id = g.item_id WHERE c.score % 4 = 0", "corpus", g=G04)
def g05_reused(s: SparkSession, d: str) -> DataFrame:
    """Stored blocks of this version as they are, the rest built; blocks of another version don't count."""
    c = view(s, d, "corpus")

    def stored(version: str, which: str) -> DataFrame:
        return c.filter(which).select("item_id", F.lit(version).alias("prompt_version"), F.concat(F.lit("stored for "), F.col("item_id")).alias("context_text"))

    old = stored("v1", "score % 8 = 0").unionByName(stored("v0", "score % 8 = 4"))
    return threads.reuse(old, c, c.filter("score % 4 = 0").select("item_id"), "v1").select("item_id", "context_text")


@query("SELECT item_id, reason, completed FROM queue WHERE NOT (reason = 'gold' AND completed = 0)", "queue")
def m06_redraw(s: SparkSession, d: str) -> DataFrame:
    """M06."""
    return review.redraw(view(s, d, "queue"))


@query("SELECT item_id, model_key, role, left(repeat(item_id, 400), 2000) AS error FROM failures WHERE NOT (model_key = 'a1' AND role = 'annotator')", "failures")
def m07_failures(s: SparkSession, d: str) -> DataFrame:
    """Failures with their text cut, one rater's cleared."""
    f = view(s, d, "failures").withColumn("error", F.repeat("item_id", 400))
    return state.cleared(state.failure(f), "a1", VERSION, "annotator").select("item_id", "model_key", "role", "error")


@query("SELECT 'd' || doc_id AS item_id FROM documents WHERE doc_id % 4 = 0 AND doc_id % 6 = 0")
def f17_revealable(s: SparkSession, d: str) -> DataFrame:
    """suggestions whose item has a human label."""
    docs = s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("item_id"))
    return review.revealable(docs.filter("doc_id % 4 = 0"), docs.filter("doc_id % 6 = 0")).select("item_id")


def _saves(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = s.read.parquet(f"{d}/documents.parquet").select("doc_id")
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    labels = lambda k: [((F.col("doc_id") + k) % 2).cast("int").alias("sarcastic"), F.lit("english").alias("language"), *(F.lit(None).cast("string").alias(x) for x in review.LABEL_KEYS[2:])]
    new = docs.filter("doc_id % 2 = 0").select(name.alias("item_id"), *labels(1), F.when(F.col("doc_id") % 4 == 0, "").otherwise("note").alias("notes"), F.lit(1).alias("is_gold"), F.lit(1).alias("votes_seen"))
    old = docs.filter("doc_id % 3 = 0").select(name.alias("item_id"), *labels(0), F.when(F.col("doc_id") % 9 == 0, '{"first": 1}').alias("first_pass_json"), F.lit(None).cast("int").alias("assist_seen"), F.lit(0).alias("votes_seen"), F.when(F.col("doc_id") % 9 == 0, "t0").alias("first_reviewed_at"), F.lit("t1").alias("reviewed_at"))
    return new, old


@query("SELECT 'd' || doc_id AS item_id, ((doc_id + 1) % 2)::INT AS sarcastic, CASE WHEN doc_id % 4 <> 0 THEN 'note' END AS notes, (doc_id % 9 = 0) AS kept_first, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END::INT AS votes_seen, CASE WHEN doc_id % 9 = 0 THEN 't0' WHEN doc_id % 3 = 0 THEN 't1' END AS first_reviewed_at FROM documents WHERE doc_id % 2 = 0")
def p15_saved_reviews(s: SparkSession, d: str) -> DataFrame:
    """A later save keeps the first pass."""
    return review.save_reviews(*_saves(s, d)).select("item_id", "sarcastic", "notes", (F.col("first_pass_json") == '{"first": 1}').alias("kept_first"), "votes_seen", "first_reviewed_at")


@query("SELECT 'd' || doc_id AS item_id, CASE WHEN doc_id % 12 = 0 THEN 1 END::INT AS assist_seen, doc_id % 9 = 0 OR doc_id % 12 = 0 AS has_first FROM documents WHERE doc_id % 3 = 0")
def m10_revealed(s: SparkSession, d: str) -> DataFrame:
    """Revealing a suggestion fixes the first pass."""
    _, old = _saves(s, d)
    some = s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("item_id"))
    return review.reveal(old, some.filter("doc_id % 4 = 0"), some).select("item_id", "assist_seen", F.col("first_pass_json").isNotNull().alias("has_first"))


_POP = r"""SELECT c.item_id, a.sarcastic_final AS label, a.language_final AS language, coalesce(try_cast(split_part(sarcasm_votes, '-', 2) AS INT) > 0 OR try_cast(split_part(sarcasm_votes, '-', 1) AS INT) < 2, false) AS split, CASE WHEN ns <= 3 THEN 'short' WHEN ns <= 5 THEN 'medium' ELSE 'long' END AS band
FROM (SELECT *, len(list_filter(regexp_split_to_array(regexp_replace(coalesce(text, ''), '([.!?…])\s+', '\1' || chr(10), 'g'), '\n+'), lambda p: regexp_matches(p, '[A-Za-zÀ-ÖØ-öø-ÿñÑ]'))) AS ns FROM candidates) c JOIN agg a ON a.item_id = c.item_id
WHERE a.sarcastic_final IS NOT NULL AND c.eligible AND NOT coalesce(c.phatic, false) AND c.item_id NOT IN (SELECT item_id FROM queue)"""


def _gold_sql() -> tuple:
    quota = """, pop AS (""" + _POP + """), st AS (SELECT label, language, split, band, count(*) AS n, count(*) * (CASE WHEN split THEN 2.0 ELSE 1.0 END) * 1.0::DOUBLE AS w,
  concat_ws(', ', label::VARCHAR, coalesce(chr(39) || language || chr(39), 'None'), CASE WHEN split THEN 'True' ELSE 'False' END, chr(39) || band || chr(39)) AS tie FROM pop GROUP BY label, language, split, band),
tot AS (SELECT sum(w) AS sw, least(sum(n), 40) AS t FROM st), sh AS (SELECT st.*, t * w / sw AS share, t, least(floor(t * w / sw)::BIGINT, n) AS whole FROM st, tot),
rest AS (SELECT max(t) - sum(whole) AS l FROM sh), bid AS (SELECT tie, row_number() OVER (ORDER BY whole + j - share, tie) AS r, l FROM sh, rest, range(100) x(j) WHERE j < least(n - whole, l)),
q AS (SELECT sh.*, whole + coalesce((SELECT count(*) FROM bid WHERE bid.tie = sh.tie AND r <= l), 0) AS quota FROM sh)
SELECT item_id, label, language, split, band FROM (SELECT pop.*, row_number() OVER (PARTITION BY pop.label, pop.language, pop.split, pop.band ORDER BY sha256('7|' || item_id), item_id) AS r, quota FROM pop JOIN q ON q.label = pop.label AND q.language IS NOT DISTINCT FROM pop.language AND q.split = pop.split AND q.band = pop.band) z WHERE r <= quota"""
    return (_with(quota, _AGG, "candidates", "queue"),)


@query(*_gold_sql())
def w11_gold_sample(s: SparkSession, d: str) -> DataFrame:
    """A draw by stratum quotas; its size is the operator's own limit."""
    c = view(s, d, "candidates")
    population = review.gold_population(_aggregates(s, d), c.select("item_id", "text"), c, view(s, d, "queue"))
    return review.gold_sample(population, 40).select("item_id", "stratum.*")


@query("SELECT m.month, m.wanted::INT AS wanted, count(c.item_id) AS found, m.wanted - count(c.item_id) AS short FROM (VALUES ('src1', 3), ('src2', 100000000), ('none', 2)) m(month, wanted) LEFT JOIN (SELECT * FROM (SELECT item_id, source, row_number() OVER (PARTITION BY source ORDER BY item_id) AS r FROM candidates WHERE item_id NOT IN (SELECT item_id FROM queue)) y WHERE (source = 'src1' AND r <= 3) OR source = 'src2') c ON c.source = m.month GROUP BY m.month, m.wanted", "candidates", "queue")
def w14_shortfall(s: SparkSession, d: str) -> DataFrame:
    """What a draw lacks of what was asked for."""
    quotas = {"src1": 3, "src2": 100_000_000, "none": 2}
    got = state.extension_sample(view(s, d, "candidates").select("item_id", F.col("source").alias("month")), view(s, d, "queue"), quotas)
    return state.shortfall(got, quotas)


@query(*_agg_sql("SELECT item_id, 2::INT AS priority FROM agg WHERE sarcastic_final IS NOT NULL UNION ALL SELECT item_id, 1::INT FROM candidates WHERE source = 'src1' AND item_id NOT IN (SELECT item_id FROM agg WHERE sarcastic_final IS NOT NULL)", "candidates"))
def m08_forked(s: SparkSession, d: str) -> DataFrame:
    """The copy's pinned targets, base items before the extension."""
    ext = view(s, d, "candidates").filter("source = 'src1'").select("item_id")
    return state.fork(view(s, d, "ratings"), _aggregates(s, d), view(s, d, "queue"), ext, LINEUP, VERSION)["target_priority"]


@query("SELECT record_type, count(*) + sum((score % 3 = 0)::INT)::BIGINT AS seen, sum((score % 2 <> 0)::INT)::BIGINT AS stored, sum((score % 2 <> 0 AND score % 3 = 0)::INT)::BIGINT AS repeated, sum(CASE WHEN score % 2 = 0 THEN 1 + (score % 3 = 0)::INT ELSE 0 END)::BIGINT AS known FROM corpus GROUP BY record_type", "corpus")
def a28_run_counters(s: SparkSession, d: str) -> DataFrame:
    c = view(s, d, "corpus").select("item_id", "record_type", "score")
    return state.run_counters(c.filter("score % 2 = 0"), c.unionByName(c.filter("score % 3 = 0")), ["item_id"])


@query("SELECT item_id, (CASE WHEN score % 2 = 0 THEN score + 1 ELSE score END)::BIGINT AS score FROM corpus", "corpus")
def m05_updated(s: SparkSession, d: str) -> DataFrame:
    """Rows with new values replace those with their keys."""
    c = view(s, d, "corpus").select("item_id", F.col("score").cast("long").alias("score"))
    table = KeyedTable.create(c, folder(s), ["item_id"])
    table.upsert(c.filter("score % 4 = 0").withColumn("score", F.lit(-1).cast("long")))
    table.compact()
    table.upsert(c.filter("score % 2 = 0").withColumn("score", F.col("score") + 1))
    return table.read()


@query("SELECT item_id, role IS NULL AS without_role, model_key FROM (SELECT item_id, NULL AS role, model_key FROM evaluations) x", "evaluations")
def p20_evaluator_rows(s: SparkSession, d: str) -> DataFrame:
    """P20: a rater's row without its role."""
    e = view(s, d, "evaluations").drop("role")
    return e.select("item_id", F.lit("role" not in e.columns).alias("without_role"), "model_key")


@query(*_agg_sql("SELECT item_id, sarcastic_final FROM agg ORDER BY sarcastic_final DESC NULLS LAST, item_id LIMIT 30"))
def o03_by_label(s: SparkSession, d: str) -> DataFrame:
    """Positives first, unlabelled last; a page of them."""
    return views.page(_aggregates(s, d), [F.desc("sarcastic_final"), F.col("item_id")], 1, 30).select("item_id", "sarcastic_final")


# --- expressions -----------------------------------------------------------------------------------------------------------


_SENTENCES = r"""list_filter(list_transform(regexp_split_to_array(regexp_replace(body, '([.!?…][)\]\x22\x27’”]?)\s+', '\1' || chr(10), 'g'), '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e]'),
  lambda x: trim(x, ' ' || chr(9) || chr(160))), lambda x: x <> '')"""


@query(f"SELECT item_id, {_SENTENCES} AS sentences FROM corpus WHERE record_type = 'comment'", "corpus")
def x06_sentences(s: SparkSession, d: str) -> DataFrame:
    """X06, all bodies; rare white space has goldens in the tests."""
    return view(s, d, "corpus").filter("record_type = 'comment'").select("item_id", text.split_sentences(F.col("body")).alias("sentences"))


@query(
    "SELECT item_id, CASE WHEN score % 2 = 0 AND len(list_filter(l, lambda x, i: i % 3 <> 1)) > 0 THEN array_to_string(list_filter(l, lambda x, i: i % 3 <> 1), chr(10)) END AS span "
    f"FROM (SELECT item_id, score, {_SENTENCES} AS l FROM corpus WHERE record_type = 'comment') x",
    "corpus",
)
def x07_joined_spans(s: SparkSession, d: str) -> DataFrame:
    """The ticked sentences of a sarcastic item's text."""
    c = view(s, d, "corpus").filter("record_type = 'comment'").withColumn("l", text.split_sentences(F.col("body")))
    ticked = F.transform("l", lambda x, i: i % 3 != 0)
    return c.select("item_id", text.join_ticked(F.col("score") % 2 == 0, F.col("l"), ticked).alias("span"))


@query("SELECT item_id, CASE WHEN length(t) <= 40 THEN t ELSE rtrim(substring(t, 1, 39)) || '…' END AS short, CASE WHEN length(t) <= 80 THEN t ELSE rtrim(substring(t, 1, 50)) || chr(10) || '[…]' || chr(10) || ltrim(right(t, 30)) END AS middle FROM (SELECT item_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM corpus) x", "corpus")
def x08_truncated(s: SparkSession, d: str) -> DataFrame:
    t = F.trim(F.regexp_replace("text", r"\s+", " "))
    return view(s, d, "corpus").select("item_id", text.truncate(t, 40).alias("short"), text.truncate_middle(t, 50, 30).alias("middle"))


_ESC = "replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(34), '&quot;'), chr(39), '&#x27;')".format


@query(
    f"SELECT item_id, replace(CASE WHEN pos > 0 AND trim(word) <> '' THEN {_ESC('substring(body, 1, pos - 1)')} || '<mark>' || {_ESC('word')} || '</mark>' || {_ESC('substring(body, pos + length(word))')} ELSE {_ESC('body')} END, chr(10), '<br>') AS html, "
    "(word <> '' AND pos = 0)::INT AS missing FROM (SELECT item_id, body, word, strpos(body, word) AS pos FROM (SELECT item_id, body, CASE WHEN score % 5 = 0 THEN 'no such words' ELSE split_part(replace(body, chr(10), ' '), ' ', 2) END AS word "
    "FROM corpus WHERE record_type = 'comment') x) y",
    "corpus",
)
def x09_highlighted(s: SparkSession, d: str) -> DataFrame:
    """In each text the first place of its second word is marked; words that the text lacks are named."""
    second = F.split_part(F.replace("body", F.lit("\n"), F.lit(" ")), F.lit(" "), F.lit(2))
    c = view(s, d, "corpus").filter("record_type = 'comment'")
    html, missing = text.highlight(F.col("body"), F.when(F.col("score") % 5 == 0, "no such words").otherwise(second))
    return c.select("item_id", html.alias("html"), F.size(missing).alias("missing"))


@query("SELECT event_id, least(4000, greatest(300, (event_id % 90) * 80))::INT AS cap FROM events")
def x13_scan_cap(s: SparkSession, d: str) -> DataFrame:
    return s.read.parquet(f"{d}/events.parquet").select("event_id", timeutil.scan_cap((F.col("event_id") % 90).cast("int")).alias("cap"))


@query("SELECT item_id, (created_s - created_s % 60 - 28800)::BIGINT AS manila, (created_s - created_s % 60)::BIGINT AS utc, NULL::BIGINT AS wrong FROM corpus", "corpus")
def x14_local_times(s: SparkSession, d: str) -> DataFrame:
    """Wall clock and zone to Unix seconds."""
    local = F.date_format(F.timestamp_seconds("created_s"), "yyyy-MM-dd HH:mm")
    at = lambda zone: timeutil.local_to_unix(F.concat(local, F.lit(" " + zone)))
    return view(s, d, "corpus").select("item_id", at("Asia/Manila").alias("manila"), at("UTC").alias("utc"), at("nowhere").alias("wrong"))


@query(f"SELECT substring({_ISO}, 1, 7) AS month, count(*) AS n FROM corpus GROUP BY 1", "corpus")
def x15_months(s: SparkSession, d: str) -> DataFrame:
    return view(s, d, "corpus").groupBy(timeutil.month_key(_iso()).alias("month")).agg(F.count("*").alias("n"))


@query("SELECT item_id, split_part(permalink, '/', 5) AS post FROM corpus", "corpus")
def x17_permalink_ids(s: SparkSession, d: str) -> DataFrame:
    return view(s, d, "corpus").select("item_id", markup.id_of_permalink(F.col("permalink")).alias("post"))


@query(
    "SELECT item_id, 'https://www.reddit.com/r/' || subreddit || CASE score % 5 WHEN 0 THEN '/search/?q=edi+wow+%26+all&restrict_sr=1&sort=' || CASE WHEN score % 2 = 0 THEN 'new' ELSE 'relevance' END || '&t=all' WHEN 1 THEN '/top/?t=week' WHEN 2 THEN '/hot/' WHEN 3 THEN '/new/' ELSE '/new/' END AS listing, "
    "'https://www.reddit.com' || permalink || '?sort=confidence' AS comments FROM corpus",
    "corpus",
)
def x18_urls(s: SparkSession, d: str) -> DataFrame:
    """X18."""
    kind = F.element_at(F.array(*map(F.lit, ("search", "top", "hot", "new", "what"))), (F.col("score") % 5 + 1).cast("int"))
    listing = markup.listing_url(F.concat(F.lit(" /r/"), F.col("subreddit")), kind, F.lit("edi wow & all"), F.when(F.col("score") % 2 == 0, "new"), F.when(kind == "top", "week"))
    return view(s, d, "corpus").select("item_id", listing.alias("listing"), markup.comments_url(F.col("permalink")).alias("comments"))


@query("SELECT item_id, substring(item_id, 4) AS short, item_id AS back, item_id AS identity FROM corpus", "corpus")
def x20_prefixes(s: SparkSession, d: str) -> DataFrame:
    c = view(s, d, "corpus")
    kind = F.when(F.col("record_type") == "submission", "t3_").otherwise("t1_")
    short = F.when(F.col("record_type") == "submission", identity.without_prefix(F.col("item_id"), "t3_")).otherwise(identity.without_prefix(F.col("item_id"), "t1_"))
    back = F.when(kind == "t3_", identity.with_prefix(short, "t3_")).otherwise(identity.with_prefix(short, "t1_"))
    return c.select("item_id", short.alias("short"), back.alias("back"), identity.record_identity(F.lit(""), F.col("record_type"), short, F.lit(None).cast("string")).alias("identity"))


def _answers(s: SparkSession, d: str) -> DataFrame:
    """Raters' answers as model text: thought first, JSON within prose, some of it invalid."""
    r = view(s, d, "ratings").filter("model_key = 'a1'").withColumn("k", F.regexp_extract("item_id", r"(\d+)", 1).cast("long"))
    cues = F.struct((F.col("cue_hyperbole") == 1).alias("hyperbole"))
    answer = F.to_json(F.struct(F.when(F.col("k") % 5 != 0, F.col("language")).otherwise("klingon").alias("language"), "literal_sentiment", "intended_sentiment", (F.col("sarcastic") == 1).alias("sarcastic"), F.when(F.col("k") % 7 != 0, F.lit(0.5)).otherwise(1.5).alias("confidence"), F.repeat(F.lit("because "), 60).alias("rationale"), cues.alias("cues")))
    return r.select("item_id", "model_key", F.concat(F.lit("<think>{not this}</think> sure: "), answer, F.lit(" done")).alias("answer"))


@query("SELECT item_id, CASE WHEN k % 5 <> 0 AND k % 7 <> 0 THEN language END AS language, CASE WHEN k % 5 <> 0 AND k % 7 <> 0 THEN sarcastic END::INT AS sarcastic, CASE WHEN k % 5 <> 0 AND k % 7 <> 0 THEN cue_hyperbole END::INT AS cue_hyperbole, CASE WHEN k % 5 <> 0 AND k % 7 <> 0 THEN 400 END::INT AS said, CASE WHEN k % 5 = 0 AND k % 7 = 0 THEN 'invalid: language, confidence' WHEN k % 5 = 0 THEN 'invalid: language' WHEN k % 7 = 0 THEN 'invalid: confidence' END AS error FROM (SELECT *, substring(item_id, 2)::BIGINT AS k FROM ratings WHERE model_key = 'a1') x", "ratings")
def p14_parsed_answers(s: SparkSession, d: str) -> DataFrame:
    """Votes from model text, and why there is none."""
    return language.parse_answers(_answers(s, d)).select("item_id", "language", "sarcastic", "cue_hyperbole", F.length("rationale").alias("said"), "error")


@query("SELECT item_id, 'context of ' || item_id || chr(10) || chr(10) || '=== TARGET (' || record_type || ') ===' || chr(10) || text AS prompt FROM corpus", "corpus")
def x27_prompts(s: SparkSession, d: str) -> DataFrame:
    return view(s, d, "corpus").select("item_id", language.prompt(F.concat(F.lit("context of "), F.col("item_id")), F.col("record_type"), F.col("text")).alias("prompt"))


def _client():
    """Answers that depend on the prompt: some only fit when asked warmly, some calls always fail, some answers never fit."""

    def ask(prompt: str, *, schema: dict, temperature: float) -> str:
        n = len(prompt)
        if n % 7 == 0:
            raise ValueError(f"no answer to {n}")
        said = {"language": "english", "literal_sentiment": "neutral", "intended_sentiment": "neutral", "sarcastic": n % 2 == 0, "confidence": 0.25, "rationale": prompt[-20:]}
        said["cues"] = {k: n % 3 == 0 for k in schema["properties"]["cues"]["required"]}
        if n % 7 == 1 or n % 7 == 2 and temperature == 0:
            said["language"] = "latin"
        return "<think>{}</think> " + json.dumps(said)

    return ask


_ASKED = """SELECT item_id, n, n % 7 = 0 AS fails, n % 7 = 1 AS never FROM (SELECT item_id, length(coalesce(text, '')) AS n FROM candidates WHERE eligible) x"""


@query(
    "SELECT item_id, CASE WHEN NOT fails AND NOT never THEN 'english' END AS language, CASE WHEN NOT fails AND NOT never THEN (n % 2 = 0)::INT END AS sarcastic, CASE WHEN NOT fails AND NOT never THEN (n % 3 = 0)::INT END AS cue_hyperbole, "
    "CASE WHEN fails OR never OR n % 7 = 2 THEN 3 ELSE 1 END::INT AS attempts, CASE WHEN fails THEN 'failed after 3 attempts: no answer to ' || n WHEN never THEN 'failed after 3 attempts: language is latin' END AS call_error FROM asked",
    "candidates",
    asked=_ASKED,
)
def u05_annotator_pass(s: SparkSession, d: str) -> DataFrame:
    """Pending items' whole texts through an injected client, with retries and the answers' schema."""
    todo = view(s, d, "candidates").filter("eligible").select("item_id", F.coalesce("text", F.lit("")).alias("prompt"))
    asked = held(language.annotate(todo, _client, pause=lambda n: 0.0))
    votes, _ = language.votes_and_failures(asked, "a9", VERSION, "annotator")
    return asked.join(votes.select("item_id", "language", "sarcastic", "cue_hyperbole"), "item_id", "left").select("item_id", "language", "sarcastic", "cue_hyperbole", "attempts", "call_error")


@query(
    _with("""SELECT c.item_id, 'about ' || c.item_id || coalesce(chr(10) || chr(10) || '=== VOTES ===' || chr(10) || v.block, '') AS prompt FROM candidates c LEFT JOIN
      (SELECT item_id, string_agg('- ' || model_key || ': ' || CASE sarcastic WHEN 1 THEN 'sarcastic' WHEN 0 THEN 'not sarcastic' ELSE 'no verdict' END || ', ' || concat_ws(', ', language, literal_sentiment, intended_sentiment) || coalesce(' (' || rationale || ')', ''), chr(10) ORDER BY model_key) AS block
       FROM ratings WHERE role = 'annotator' AND prompt_version = 'v3' AND model_key IN ('a1', 'a2', 'a3') GROUP BY item_id) v ON v.item_id = c.item_id""", _AGG, "candidates")
)
def u06_adjudicator_prompts(s: SparkSession, d: str) -> DataFrame:
    """What an adjudicator is asked: the prompt and the raters' votes."""
    prompts = view(s, d, "candidates").select("item_id", F.concat(F.lit("about "), F.col("item_id")).alias("prompt"))
    return language.adjudicator_prompts(prompts, view(s, d, "ratings"), LINEUP, VERSION)


@query("SELECT item_id, CASE WHEN n % 3 = 0 THEN 'positive' WHEN n % 3 = 1 THEN 'neutral' ELSE 'negative' END AS label, CASE WHEN n % 3 = 0 THEN 0.6667 ELSE 0.1667 END::DOUBLE AS p_pos FROM (SELECT item_id, length(coalesce(text, '')) AS n FROM candidates) x", "candidates")
def u03_sentiment(s: SparkSession, d: str) -> DataFrame:
    """A batch scorer's probabilities, rounded, and the likeliest label."""
    score = lambda texts: [tuple(2 / 3 if i == len(t) % 3 else 1 / 6 for i in range(3)) for t in texts]
    return language.sentiment(view(s, d, "candidates"), score).select("item_id", "label", "p_pos")


_KIND = "CASE WHEN list_contains({0}, t) THEN 'tl' WHEN list_contains({1}, t) THEN 'en' WHEN suffix(t, 'ng') THEN 'tl' WHEN suffix(t, 's') THEN 'en' ELSE 'other' END"


def _model_sql() -> str:
    kinds = _KIND.format(_LIST(language.TAGALOG), _LIST(language.ENGLISH))
    ratio = "len(list_filter(k, lambda x: x = '{0}')) / greatest(1, len(k))::DOUBLE".format
    return f"SELECT doc_id, CASE WHEN len(k) = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'english' ELSE 'tagalog' END WHEN {ratio('en')} >= 0.6 THEN 'english' WHEN {ratio('tl')} >= 0.6 THEN 'tagalog' ELSE 'taglish' END AS language, round({ratio('tl')}, 4) AS tl_ratio FROM (SELECT doc_id, list_transform(list_transform(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÖØ-öø-ÿ''ñÑ]+'), lambda x: lower(x)), lambda t: {kinds}) AS k FROM documents) y"


@query(_model_sql())
def u01_with_a_model(s: SparkSession, d: str) -> DataFrame:
    """Words outside the lists by a model's rule, texts without words by their message's label."""
    docs = s.read.parquet(f"{d}/documents.parquet")
    word = lambda w: F.when(w.endswith("ng"), "tl").when(w.endswith("s"), "en").otherwise("other")
    r = language.identify(F.col("text"), 0.6, F.when(F.col("doc_id") % 2 == 0, "en").otherwise("tl"), word)
    return docs.select("doc_id", r.alias("r")).select("doc_id", "r.language", "r.tl_ratio")


@query("SELECT item_id, map_keys(m)[1] AS first_rater, cardinality(m)::INT AS n FROM (SELECT item_id, map_from_entries(list((model_key, rationale) ORDER BY model_key)) AS m FROM ratings WHERE role = 'annotator' GROUP BY item_id) x", "ratings")
def x24_votes_map(s: SparkSession, d: str) -> DataFrame:
    """raters' reasons as a map, read back from its JSON text."""
    m = view(s, d, "ratings").filter("role = 'annotator'").groupBy("item_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("model_key", "rationale"))))).alias("j"))
    back = F.from_json("j", "map<string, string>")
    return m.select("item_id", F.array_sort(F.map_keys(back))[0].alias("first_rater"), F.size(back).alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN least(event_id % 400, 300)::DOUBLE ELSE 30.0::DOUBLE END AS wait, 'WARNING ' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || ' throttled id=' || event_id || ' kind=' || event_type AS line FROM events")
def x30_log_lines(s: SparkSession, d: str) -> DataFrame:
    """Waits of retry headers, log lines."""
    e = s.read.parquet(f"{d}/events.parquet")
    wait = timeutil.retry_after(F.when(F.col("event_id") % 3 == 0, (F.col("event_id") % 400).cast("string")).otherwise("soon"), 30.0, 300.0)
    fields = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("id"), F.col("event_id").cast("string"))
    return e.select("event_id", wait.alias("wait"), timeutil.log_line(F.lit("WARNING"), F.col("ts"), F.lit("throttled"), fields).alias("line"))


@query("SELECT item_id FROM corpus WHERE subreddit = 'sub1' ORDER BY created_s DESC, item_id LIMIT 40", "corpus")
def f13_feed(s: SparkSession, d: str) -> DataFrame:
    """one feed's newest; the limit is the operator's own."""
    return views.page(view(s, d, "corpus").filter("subreddit = 'sub1'"), [F.desc("created_s"), F.col("item_id")], 1, 40).select("item_id")


@query("SELECT model_key AS source, count(*)::VARCHAR AS n FROM (SELECT e.model_key FROM evaluations e JOIN reviews r ON r.item_id = e.item_id WHERE r.sarcastic IS NOT NULL AND e.sarcastic IS NOT NULL AND r.is_gold <> 0) x GROUP BY 1", "evaluations", "reviews")
def k09_report(s: SparkSession, d: str) -> DataFrame:
    """The report's text, its table read back line by line."""
    gold = view(s, d, "reviews").filter("is_gold <> 0").select("item_id", "sarcastic")
    judged = view(s, d, "evaluations").select("item_id", F.col("model_key").alias("source"), F.col("sarcastic").alias("predicted"))
    kinds = judged.select("source", F.lit("evaluator").alias("kind")).distinct()
    rows = [r.asDict() for r in agreement.evaluation_report(gold, judged, kinds).collect()]  # a row a rater
    lines = agreement.report_markdown(rows, VERSION, 0, 0).splitlines()[6:]
    return s.createDataFrame([tuple(x.strip() for x in line.split("|")[1:4:2]) for line in lines], "source string, n string")


_REGISTERED = "SELECT 'd' || doc_id AS prompt_version, sha256(CASE WHEN quality = 1 THEN 'q' ELSE 'other' END || doc_id || chr(10) || 'schema') AS content_hash FROM labels WHERE doc_id % 3 <> 0"


@query(
    "SELECT 'd' || l.doc_id AS prompt_version, sha256('q' || l.doc_id || chr(10) || 'schema') AS content_hash, CASE WHEN r.prompt_version IS NULL THEN 'new' WHEN r.content_hash = sha256('q' || l.doc_id || chr(10) || 'schema') THEN 'known' ELSE 'changed' END AS state FROM labels l LEFT JOIN r ON r.prompt_version = 'd' || l.doc_id",
    r=_REGISTERED,
)
def x23_prompt_versions(s: SparkSession, d: str) -> DataFrame:
    """Prompt versions against those registered: new, known, or changed under an old name."""
    lab = s.read.parquet(f"{d}/labels.parquet")
    name, text_ = F.concat(F.lit("d"), F.col("doc_id").cast("string")), lambda x: F.concat(x, F.col("doc_id").cast("string"))
    digest = lambda x: F.sha2(F.concat(x, F.lit("\nschema")), 256)
    old = lab.filter("doc_id % 3 <> 0").select(name.alias("prompt_version"), digest(text_(F.when(F.col("quality") == 1, "q").otherwise("other"))).alias("content_hash"))
    now = lab.select(name.alias("prompt_version"), text_(F.lit("q")).alias("prompt"), F.lit("schema").alias("schema"))
    return language.version_states(old, now)


def _archive(s: SparkSession, d: str, at: str, when: str = "true") -> paged.TableArchive:
    """Events as a stored archive, by day."""
    e = s.read.parquet(f"{d}/events.parquet").filter(when)
    rows = e.select(F.col("event_id").alias("id"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("created_utc"), F.col("event_type").alias("kind"), F.to_date("ts").cast("string").alias("day"))
    rows.repartition("day").write.mode("append").partitionBy("day").parquet(at)
    return paged.TableArchive(at, "id long, created_utc long, kind string, day date")


_BOUNDS = "SELECT min(CAST(ts AS DATE)) + 2 AS a, min(CAST(ts AS DATE)) + 9 AS z FROM events"


@query("SELECT event_id AS id, floor(epoch(ts))::BIGINT AS created_utc, event_type AS kind, CAST(ts AS DATE) AS day FROM events, b WHERE CAST(ts AS DATE) BETWEEN a AND z", b=_BOUNDS)
def u09_feed(s: SparkSession, d: str) -> DataFrame:
    """A plugged-in archive read page by page; the filter on the day chooses the partitions."""
    archive = _archive(s, d, f"{folder(s)}/archive")
    s.dataSource.register(paged.paged_source("archive", archive))
    a, z = s.read.parquet(f"{d}/events.parquet").agg(F.min(F.to_date("ts")).alias("m")).select(F.date_add("m", 2).cast("string"), F.date_add("m", 9).cast("string")).first()
    with paged.filters_pushed(s):
        days = F.col("day").between(F.lit(a).cast("date"), F.lit(z).cast("date"))
        return held(s.read.format("archive").option("start", "2020-01-01").option("page", "40").option("prune", "true").load().filter(days))


@query("SELECT event_id AS id, floor(epoch(ts))::BIGINT AS created_utc, event_type AS kind, CAST(ts AS DATE) AS day FROM events")
def s06_paged_stream(s: SparkSession, d: str) -> DataFrame:
    """The archive as a stream, in two runs on one checkpoint while it grows: nothing is missed, nothing comes twice."""
    at = folder(s)
    start, cut = s.read.parquet(f"{d}/events.parquet").agg(F.min(F.to_date("ts")).alias("a"), F.date_add(F.min(F.to_date("ts")), 12).alias("z")).select(F.col("a").cast("string"), F.col("z").cast("string")).first()
    for when in (f"ts < '{cut}'", f"ts >= '{cut}'"):
        archive = _archive(s, d, f"{at}/archive", when)
        s.dataSource.register(paged.paged_source("archive", archive))
        stream = s.readStream.format("archive").option("start", start).option("page", "60").load()
        _run(stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/ckpt").trigger(availableNow=True).start())
    return s.read.schema(stream.schema).parquet(f"{at}/out")


@query("SELECT doc_id::VARCHAR AS item_id, NULL::VARCHAR AS model_key, lang AS language, NULL::INT AS sarcastic, CASE WHEN doc_id % 2 = 0 THEN (doc_id % 10)::DOUBLE END AS confidence FROM documents")
def m09_migrated(s: SparkSession, d: str) -> DataFrame:
    """Rows of two older shapes brought to one schema: columns that they lack are null, kinds are the schema's."""
    docs = s.read.parquet(f"{d}/documents.parquet")
    one = docs.filter("doc_id % 2 = 1").select(F.col("doc_id").alias("item_id"), F.col("lang").alias("language"))
    two = docs.filter("doc_id % 2 = 0").select(F.col("doc_id").cast("string").alias("item_id"), F.col("lang").alias("language"), (F.col("doc_id") % 10).cast("int").alias("confidence"), F.lit(1).alias("left_over"))
    return state.migrated(one, RATING).unionByName(state.migrated(two, RATING)).select("item_id", "model_key", "language", "sarcastic", "confidence")


# --- streams -----------------------------------------------------------------------------------------------------------------


def _run(q: StreamingQuery) -> None:
    """To the end of what is there, however long that takes: a stream that is stopped before has only a part of its rows. Raises what it failed of."""
    q.awaitTermination()


def _drained(stream: DataFrame, s: SparkSession) -> DataFrame:
    """What a stream gives for all that is there now."""
    at = folder(s)
    _run(awaiting.start(stream, f"{at}/out", f"{at}/ckpt"))
    return s.read.schema(stream.schema).parquet(f"{at}/out")


@query("SELECT item_id, record_type FROM corpus", "corpus")
def z01_incremental(s: SparkSession, d: str) -> DataFrame:
    """Two rounds over growing JSON lines; what is stored is not stored again."""
    at, r = folder(s), _records(s, d).drop("subreddit")
    for part in ("score % 2 = 0", "score % 3 = 0 OR score % 2 = 1"):
        r.filter(part).write.mode("append").json(f"{at}/in")
        _run(ingest.merge_new(ingest.records(s, f"{at}/in", 50), f"{at}/table", ["reddit_fullname"], f"{at}/ckpt"))
    return s.read.parquet(f"{at}/table").select(F.col("reddit_fullname").alias("item_id"), "record_type")


def _event_files(s: SparkSession, d: str) -> str:
    at = folder(s)
    s.read.parquet(f"{d}/events.parquet").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts")).repartition(1).write.parquet(f"{at}/in")
    return f"{at}/in"


@query("SELECT day, event_type, count(*) AS n FROM (SELECT CAST(ts AS DATE) AS day, event_type FROM events) x WHERE day + 1 <= (SELECT max(ts) - INTERVAL 3 DAY FROM events) GROUP BY 1, 2")
def z02_released_days(s: SparkSession, d: str) -> DataFrame:
    """Days that the stream has passed by the horizon, no row of the future."""
    stream = s.readStream.schema("event_id long, event_type string, ts timestamp").parquet(_event_files(s, d))
    return _drained(ingest.day_counts(ingest.not_future(stream)), s)


@query("SELECT c.item_id, c.submission_item FROM corpus c JOIN corpus p ON p.item_id = c.submission_item AND p.record_type = 'submission' WHERE c.record_type = 'comment' AND c.created_s BETWEEN p.created_s AND p.created_s + 180", "corpus")
def z04_joined_streams(s: SparkSession, d: str) -> DataFrame:
    """Comments meet their post while it waits, not later than the horizon."""
    at, c = folder(s), view(s, d, "corpus").select("item_id", "record_type", "submission_item", F.timestamp_seconds("created_s").alias("ts"))
    kind = "item_id string, record_type string, submission_item string, ts timestamp"
    for name in ("submission", "comment"):
        c.filter(F.col("record_type") == name).repartition(1).write.parquet(f"{at}/{name}")
    posts, comments = (s.readStream.schema(kind).parquet(f"{at}/{name}") for name in ("submission", "comment"))
    return _drained(ingest.comments_of_posts(posts, comments, "3 minutes").select("item_id", "submission_item"), s)


#: Conversations as a stream in which a reply comes hours after its post, some days behind; the horizon is half a day.
_SLOW = "SELECT item_id, record_type, submission_item, created_s + CASE WHEN record_type = 'comment' THEN (score % 23) * 7200 ELSE 0 END AS s FROM corpus WHERE record_type = 'comment' OR score % 10 <> 0"
_CLOSED = "SELECT *, (s // 86400 + 1) * 86400 AS day_end, (SELECT max(s) FROM slow) - 43200 AS passed FROM slow"


@query(
    """SELECT p.item_id AS post, 'released' AS kind, p.s * 1000 AS ms, count(c.item_id) AS n, coalesce(string_agg(c.item_id, ',' ORDER BY c.s, c.item_id), '') AS items
    FROM closed p LEFT JOIN closed c ON c.record_type = 'comment' AND c.submission_item = p.item_id AND c.s < p.day_end + 43200
    WHERE p.record_type = 'submission' AND p.day_end <= p.passed GROUP BY p.item_id, p.s
    UNION ALL SELECT c.submission_item, 'late', c.s * 1000, 1, c.item_id FROM closed c LEFT JOIN closed p ON p.record_type = 'submission' AND p.item_id = c.submission_item
    WHERE c.record_type = 'comment' AND c.day_end <= c.passed AND (p.item_id IS NULL OR c.s >= p.day_end + 43200)""",
    "corpus",
    slow=_SLOW,
    closed=_CLOSED,
)
def z02_released_posts(s: SparkSession, d: str) -> DataFrame:
    """Posts go out once with their comments when the stream has passed their day and the horizon; later replies, and
    those to posts that were never collected, go out by themselves."""
    at, c = folder(s), view(s, d, "corpus").filter("record_type = 'comment' OR score % 10 <> 0")
    delay = F.when(F.col("record_type") == "comment", F.col("score") % 23 * 7200).otherwise(0)
    rows = c.select("item_id", "record_type", "submission_item", F.timestamp_seconds(F.col("created_s") + delay).alias("ts"))
    rows.repartitionByRange(4, "ts").write.parquet(f"{at}/in")
    got = _drained(awaiting.released_posts(s.readStream.schema(rows.schema).parquet(f"{at}/in"), "12 hours"), s)
    return got.select("post", "kind", "ms", "n", F.array_join("items", ",").alias("items"))


@query("SELECT event_type AS key, CAST(ts AS DATE) AS day, event_id AS id, epoch_us(ts) AS us FROM (SELECT *, row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id) AS r FROM events) x WHERE r <= 7 AND CAST(ts AS DATE) + 1 <= (SELECT max(ts) FROM events)")
def z06_day_caps(s: SparkSession, d: str) -> DataFrame:
    """A kind's newest seven events of each day, given out when the day is over."""
    stream = s.readStream.schema("event_id long, event_type string, ts timestamp").parquet(_event_files(s, d))
    return _drained(awaiting.day_caps(stream, "event_type", 7), s).select("key", F.date_from_unix_date("day").alias("day"), "id", "us")
