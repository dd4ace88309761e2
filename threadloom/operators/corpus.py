"""Corpus index (P01-P07, P13, P16, W08, S01's dedup) and its counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import is_bot, pseudonym, record_identity, without_prefix
from ..functions.text import strip
from ..functions.timeutil import parse_utc


def text_of(record_type: Column, title: Column, selftext: Column, body: Column) -> Column:
    post = strip(F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(selftext, F.lit(""))))
    return F.when(record_type == "submission", post).otherwise(F.coalesce(body, F.lit("")))


def normalized(raw: DataFrame, run_id: str, key: bytes, sampling: str = "natural", keyword: str | None = None) -> DataFrame:
    """Raw rows of either kind to records; names go, pseudonyms come; casts and defaults as in the contract."""
    post = F.col("record_type") == "submission"
    digest, status = pseudonym(F.col("author"), key)
    flags = [c for c in ("spoiler", "stickied", "locked", "archived", "is_original_content", "is_submitter") if c in raw.columns]
    counts = [c for c in ("num_crossposts", "gilded", "controversiality") if c in raw.columns]
    out = raw.withColumns({c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in flags} | {c: F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in counts})
    return out.withColumns(
        {
            "collection_run_id": F.lit(run_id),
            "author_hash": digest,
            "author_status": status,
            "parent_record_type": F.when(~post, F.when(F.col("parent_id").startswith("t3_"), "submission").otherwise("comment")),
            "submission_id": F.when(~post, without_prefix(F.col("link_id"), "t3_")),
            "depth": F.when(~post, F.coalesce(F.col("depth"), F.lit(0))),
            "sampling_strategy": F.lit(sampling),
            "matched_query_or_keyword": F.lit(keyword),
        }
    ).drop("author")


def index(records: DataFrame, key: bytes | None = None) -> DataFrame:
    """Records to corpus rows; rows without identity or kind are left out (S01 counts them with `rejected`)."""
    post = F.col("record_type") == "submission"
    item = record_identity(F.col("reddit_fullname"), F.col("record_type"), F.col("reddit_id"), F.col("id"))
    flag = lambda c: F.col(c).cast("boolean").cast("int")
    rows = records.withColumn("item_id", item).filter(F.col("item_id").isNotNull() & F.col("record_type").isin("submission", "comment"))
    return rows.select(
        "item_id",
        "record_type",
        F.coalesce("subreddit", F.lit("")).alias("subreddit"),
        F.when(post, F.col("item_id")).otherwise(F.concat(F.lit("t3_"), F.nullif("submission_id", F.lit("")))).alias("submission_item"),
        F.when(~post, F.col("parent_id")).alias("parent_item"),
        F.when(~post, F.col("depth")).alias("depth"),
        "created_utc",
        parse_utc(F.col("created_utc")).alias("ts"),
        "author_hash",
        "author_status",
        F.when(~post, flag("is_submitter")).alias("is_submitter"),
        is_bot(F.col("author"), F.col("author_hash"), key=key).cast("int").alias("is_bot"),
        "distinguished",
        F.coalesce(flag("stickied"), F.lit(0)).alias("stickied"),
        F.when(post, flag("is_self")).alias("is_self"),
        "score",
        "sampling_strategy",
        "matched_query_or_keyword",
        F.when(post, F.coalesce("title", F.lit(""))).alias("title"),
        F.when(post, F.coalesce("selftext", F.lit(""))).alias("selftext"),
        F.when(~post, F.coalesce("body", F.lit(""))).alias("body"),
        text_of(F.col("record_type"), F.col("title"), F.col("selftext"), F.col("body")).alias("text"),
        "permalink",
    )


def rejected(records: DataFrame) -> DataFrame:
    item = record_identity(F.col("reddit_fullname"), F.col("record_type"), F.col("reddit_id"), F.col("id"))
    return records.filter(item.isNull() | ~F.coalesce(F.col("record_type").isin("submission", "comment"), F.lit(False)))


def first_seen(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; order keys must settle ties."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_n = 1").drop("_n")


def inherit_sampling(corpus: DataFrame) -> DataFrame:
    """A comment without a strategy takes its submission's strategy and keyword, if that submission is there."""
    posts = corpus.filter("record_type = 'submission'").select(F.col("item_id").alias("_of"), F.col("sampling_strategy").alias("_s"), F.col("matched_query_or_keyword").alias("_k"))
    takes = (F.col("record_type") == "comment") & F.col("sampling_strategy").isNull() & F.col("_of").isNotNull()
    out = corpus.join(posts, F.col("submission_item") == F.col("_of"), "left")
    fixed = {c: F.when(takes, F.col(n)).otherwise(F.col(c)) for c, n in (("matched_query_or_keyword", "_k"), ("sampling_strategy", "_s"))}
    return out.select(*(fixed.get(c, F.col(c)).alias(c) if c in fixed else F.col(c) for c in corpus.columns))


def is_text_only(record_type: Column, is_self: Column, selftext: Column) -> Column:
    """P13."""
    return (record_type != "submission") | F.coalesce(is_self.cast("int") != 0, F.lit(False)) | (strip(F.coalesce(selftext, F.lit(""))) != "")


def counts(corpus: DataFrame) -> DataFrame:
    """Zeros, not NULLs, for an empty corpus."""
    return corpus.agg(F.count("*").alias("total"), F.count_if(F.col("record_type") == "submission").alias("submissions"), F.count_if(F.col("record_type") == "comment").alias("comments"))


def subreddit_stats(corpus: DataFrame, seen: str = "created_s") -> DataFrame:
    """A01."""
    return corpus.groupBy("subreddit").agg(F.count_if(F.col("record_type") == "submission").alias("submissions"), F.count_if(F.col("record_type") == "comment").alias("comments"), F.max(seen).alias("last_seen"))
