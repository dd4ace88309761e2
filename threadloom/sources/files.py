"""File readers (S01-S05, S17-S20, S14, S15, S22, S23, U09) and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.identity import record_identity
from ..functions.text import strip
from ..operators.corpus import first_seen
from ..schemas import FIXTURE, MANIFEST, RECORD


def _identity() -> Column:
    return record_identity(F.col("reddit_fullname"), F.col("record_type"), F.col("reddit_id"), F.col("id"))


def jsonl(spark: SparkSession, path: str | list[str], unique: bool = True) -> DataFrame:
    """Records of all JSON-lines files below a folder, with `bad` lines marked (not JSON, no object, no identity). With `unique` the first good row of each identity stays, by file path and place in the file."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{json,jsonl}").option("lineSep", "\n").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line")).filter(strip(F.col("value")) != "")
    rows = lines.select("_file", "_block", "_line", F.from_json("value", RECORD).alias("r")).select("_file", "_block", "_line", "r.*").withColumn("item_id", _identity()).withColumn("bad", F.col("item_id").isNull())
    # write_records leaves the subreddit to the folder's name
    folder = F.nullif(F.url_decode(F.regexp_extract("_file", "/subreddit=([^/]+)/", 1)), F.lit(""))
    rows = rows.withColumn("subreddit", F.coalesce("subreddit", F.when(~F.col("bad"), folder)))
    if not unique:
        return rows.drop("_block", "_line")
    good = first_seen(rows.filter("NOT bad"), ["item_id"], [F.col("_file"), F.col("_block"), F.col("_line")])
    return good.unionByName(rows.filter("bad")).drop("_block", "_line")


def fixture(spark: SparkSession, path: str) -> DataFrame:
    """One row a record from the nested JSON: posts, then their comments, with their places."""
    posts = spark.read.option("multiLine", "true").schema(FIXTURE).json(path).select(F.posexplode("submissions").alias("post_no", "p"))
    a = posts.select("post_no", F.lit(None).cast("int").alias("comment_no"), F.lit("submission").alias("record_type"), "p.*").drop("comments")
    b = posts.select("post_no", F.posexplode("p.comments").alias("comment_no", "c")).select("post_no", "comment_no", F.lit("comment").alias("record_type"), "c.*")
    return a.unionByName(b, allowMissingColumns=True)


_POST_NEEDS = ("id", "name", "subreddit", "title", "selftext", "author", "created_utc", "score", "num_comments", "num_crossposts", "upvote_ratio", "is_self", "over_18", "spoiler", "stickied", "locked", "archived", "is_original_content", "permalink", "url")
_COMMENT_NEEDS = ("id", "name", "subreddit", "body", "author", "link_id", "parent_id", "permalink", "created_utc", "score", "depth", "controversiality", "is_submitter", "stickied")


def fixture_errors(rows: DataFrame, strict: bool = False) -> DataFrame:
    """The fixture's rows with `errors`; strict raises on the first row that has any."""
    post = F.col("record_type") == "submission"
    of = rows.filter(post).select(F.col("post_no").alias("_p"), F.col("id").alias("_post_id"), F.col("subreddit").alias("_post_sub"))
    r = rows.join(of, F.col("post_no") == F.col("_p"), "left").withColumn("_same", F.count("*").over(Window.partitionBy("name")))
    need = lambda names, when: [F.when(when & F.col(c).isNull(), F.lit(f"missing {c}")) for c in names if c in rows.columns]
    bad = [
        *need(_POST_NEEDS, post),
        *need(_COMMENT_NEEDS, ~post),
        F.when(post & ~F.col("name").startswith("t3_"), "name must start with t3_"),
        F.when(~post & ~F.col("name").startswith("t1_"), "name must start with t1_"),
        F.when(F.col("name").isNotNull() & (F.col("_same") > 1), "duplicate name"),
        F.when(~post & F.col("parent_id").startswith("t3_") & (F.substring("parent_id", 4, 1 << 30) != F.col("_post_id")), "parent is another post"),
        F.when(~post & (F.col("subreddit") != F.col("_post_sub")), "subreddit differs from the post's"),
    ]
    out = r.withColumn("errors", F.array_compact(F.array(*bad))).drop("_p", "_post_id", "_post_sub", "_same")
    if strict:
        message = F.concat(F.col("name"), F.lit(": "), F.array_join("errors", "; "))
        out = out.withColumn("errors", F.when(F.size("errors") > 0, F.raise_error(message).cast("array<string>")).otherwise(F.col("errors")))
    return out


def archive(spark: SparkSession, path: str, subreddits: list[str], start: str, end: str) -> DataFrame:
    """Raw rows of some feeds and UTC days from files partitioned by subreddit and day; both prune files. Overlaps of pages fall to one row an id."""
    days = spark.read.option("basePath", path).json(path)
    mine = days.filter(F.col("subreddit").isin(*subreddits) & F.col("day").between(start, end))
    return first_seen(mine, ["id"], [F.col("created_utc"), F.col("id")])


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a text file, comments and blanks out, first mention kept."""
    lines = spark.read.option("lineSep", "\n").text(path).select(strip(F.element_at(F.split("value", "#"), 1)).alias("item_id"), F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")).alias("line"))
    return first_seen(lines.filter("item_id <> ''"), ["item_id"], [F.col("line")])


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """One row a run; unreadable files leave no row."""
    return spark.read.option("multiLine", "true").schema(MANIFEST).json(path).filter("collection_run_id IS NOT NULL")


def endpoints(lines: DataFrame) -> DataFrame:
    """S20/X28/A31's rows: line_no, scheme, host, port, user, provider, masked, ok, repeated, from lines of `scheme://[user:pass@]host:port`, `user:pass@host:port`, `host:port:user:pass`, `user:pass:host:port` or `host:port`; the first of equal ones counts."""
    v = strip(F.regexp_replace("value", "#.*$", ""))
    rows = lines.withColumn("v", v).filter("v <> ''")
    # pattern, and which group is scheme, user, pass, host, port; the first that fits
    shapes = [
        (r"^(?:(\w+)://)?(?:([^:@\s]+):([^@\s]+)@)?([^:@\s/]+):(\d+)$", (1, 2, 3, 4, 5)),
        (r"^([^:@\s/]+):(\d+):([^:\s]+):(\S+)$", (0, 3, 4, 1, 2)),
        (r"^([^:@\s/]+):([^:\s]+):([^:@\s/]+):(\d+)$", (0, 1, 2, 3, 4)),
    ]

    def part(i: int) -> Column:
        return F.coalesce(*(F.when(F.col("v").rlike(p), F.nullif(F.regexp_extract("v", p, at[i]), F.lit("")) if at[i] else F.lit(None)) for p, at in shapes))

    port = part(4).try_cast("int")
    ok = F.coalesce(port.between(1, 65535), F.lit(False))
    got = rows.select("line_no", F.coalesce(part(0), F.lit("http")).alias("scheme"), part(1).alias("user"), part(2).alias("_pass"), part(3).alias("host"), port.alias("port"), ok.alias("ok"))
    same = Window.partitionBy("scheme", "user", "_pass", "host", "port", "ok").orderBy("line_no")
    host = F.col("host")
    provider = F.when(host.rlike(r"^\d+(\.\d+){3}$"), "raw IP").otherwise(F.lower(F.regexp_extract(host, r"([^.]+\.[^.]+|[^.]+)$", 1)))
    masked = F.concat("scheme", F.lit("://"), F.when(F.col("user").isNotNull(), F.lit("***:***@")).otherwise(F.lit("")), host, F.lit(":"), F.col("port").cast("string"))
    out = got.withColumn("repeated", F.col("ok") & (F.row_number().over(same) > 1))
    return out.select("line_no", *(F.when(F.col("ok"), c).alias(n) for n, c in (("scheme", F.col("scheme")), ("host", host), ("port", F.col("port")), ("user", F.col("user")), ("provider", provider), ("masked", masked))), "ok", "repeated")


def endpoint_report(found: DataFrame) -> DataFrame:
    """Kept, repeated and wrong lines, the wrong ones' numbers, and endpoints of a scheme that takes no user in a browser."""
    kept = F.col("ok") & ~F.col("repeated")
    return found.agg(F.count_if(kept).alias("kept"), F.count_if("repeated").alias("repeated"), F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("line_no")))).alias("wrong_lines"), F.count_if(kept & F.lower("scheme").startswith("socks") & F.col("user").isNotNull()).alias("socks_with_user"))


def run_totals(rows: DataFrame, kind: str, since: str = "") -> DataFrame:
    """Of manifests of one source from a day on: runs, and what they stored."""
    mine = rows.filter((F.col("source") == kind) & (F.coalesce("started_at_utc", F.lit("")) >= since))
    return mine.agg(F.count("*").alias("runs"), F.coalesce(F.sum("submissions_stored"), F.lit(0)).alias("posts"), F.coalesce(F.sum("comments_stored"), F.lit(0)).alias("comments"))


def cards(snapshots: DataFrame, cap: int | None = None) -> DataFrame:
    """Listing cards of page snapshots: promoted ones and those without id or permalink out, the first sight of each stays, in arrival order."""
    good = snapshots.filter(~F.coalesce("promoted", F.lit(False)) & F.col("id").startswith("t3_") & (F.coalesce("permalink", F.lit("")) != ""))
    once = first_seen(good, ["id"], [F.col("snapshot_no"), F.col("pos")])
    return once if cap is None else once.orderBy("snapshot_no", "pos").limit(cap)


def merged(primary: DataFrame, extra: DataFrame) -> DataFrame:
    """Rows of both, the primary's where both have an id."""
    both = primary.withColumn("_rank", F.lit(0)).unionByName(extra.withColumn("_rank", F.lit(1)), allowMissingColumns=True)
    return first_seen(both, ["id"], [F.col("_rank"), F.col("pos")]).drop("_rank")


def topped_up(primary: DataFrame, extra: DataFrame, posts: DataFrame) -> DataFrame:
    """Comments from the page are added only for posts whose listing had none, was cut off, or lacks more than two of the stated number."""
    have = primary.groupBy("link_id").agg(F.count("*").alias("_n"))
    short = posts.join(have, "link_id", "left").filter(F.col("_n").isNull() | F.col("truncated") | (F.col("listed") > F.col("_n") + 2)).select("link_id")
    return merged(primary, extra.join(short, "link_id", "left_semi"))


def write_records(records: DataFrame, path: str) -> None:
    """JSON lines by subreddit and UTC day of collection."""
    day = F.to_date(F.col("retrieved_at_utc").try_cast("timestamp")).alias("collected_date")
    records.select("*", day).write.mode("append").partitionBy("subreddit", "collected_date").json(path)


def write_manifest(row: DataFrame, path: str) -> None:
    """K02."""
    row.coalesce(1).write.mode("append").json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """K08."""
    rows.write.mode("overwrite").option("header", "true").csv(path)
