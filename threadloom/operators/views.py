"""Browser and dashboard frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import display, length_band

SITE = "https://www.reddit.com"  # a fixed value: the site whose permalinks the records hold


def absolute(permalink: Column, base: str = SITE) -> Column:
    """P07."""
    return F.when(permalink.startswith("http"), permalink).otherwise(F.concat(F.lit(base), permalink))


def browser(corpus: DataFrame) -> DataFrame:
    """Comments with their post's title; in browsing order."""
    posts = corpus.filter("record_type = 'submission'").select(F.col("item_id").alias("_p"), F.col("title").alias("post_title"))
    rows = corpus.join(posts, F.col("submission_item") == F.col("_p"), "left")
    reply = F.when(F.col("record_type") == "submission", F.lit(None)).when(F.col("parent_item") == F.col("submission_item"), "post").otherwise(F.col("parent_item"))
    return rows.select("item_id", "submission_item", "record_type", "depth", "parent_item", "created_s", display(F.coalesce("post_title", F.lit(""))).alias("post_title"), reply.alias("reply_to"), display(F.col("text")).alias("shown"))


def browsing_order() -> list[Column]:
    return [F.col("submission_item"), (F.col("record_type") != "submission").cast("int"), F.coalesce("depth", F.lit(0)), F.coalesce("parent_item", F.lit("")), F.col("created_s"), F.col("item_id")]


def rationale_pivot(ratings: DataFrame, lineup: list[str]) -> DataFrame:
    """One column a rater; the values are given, so no pass is spent on finding them."""
    return ratings.filter("role = 'annotator'").groupBy("item_id", "prompt_version").pivot("model_key", lineup).agg(F.first("rationale", ignorenulls=True))


def annotated(aggregates: DataFrame, corpus: DataFrame, ratings: DataFrame, lineup: list[str]) -> DataFrame:
    """Final labels with the post's title and each rater's reason."""
    posts = corpus.select(F.col("item_id").alias("_p"), F.col("title").alias("post_title"))
    rows = aggregates.join(corpus.select("item_id", "submission_item", "text", "subreddit"), "item_id").join(posts, F.col("submission_item") == F.col("_p"), "left").drop("_p")
    return rows.join(rationale_pivot(ratings, lineup), ["item_id", "prompt_version"], "left")


def masks(rows: DataFrame, needle: str | None = None, labels: list[int] | None = None, languages: list[str] | None = None, resolved: list[str] | None = None, text: str = "text") -> DataFrame:
    """literal, case-insensitive search and list filters."""
    if needle:
        rows = rows.filter(F.contains(F.lower(F.col(text)), F.lit(needle.lower())))
    for column, wanted in (("sarcastic_final", labels), ("language_final", languages), ("resolved_by", resolved)):
        if wanted:
            rows = rows.filter(F.col(column).isin(*wanted))
    return rows


def facets(rows: DataFrame, column: str) -> DataFrame:
    """O11."""
    return rows.filter(F.col(column).isNotNull()).select(column).distinct()


def positive_share(rows: DataFrame) -> DataFrame:
    """A33."""
    yes = F.count_if(F.col("sarcastic_final") == 1)
    return rows.agg(F.count("*").alias("n"), yes.alias("positives"), F.round(yes / F.greatest(F.lit(1), F.count("*")), 4).alias("share"))


def length_profile(rows: DataFrame) -> DataFrame:
    """Band, items, share of all, sarcastic and split shares. `rows` has text, sarcastic_final, split."""
    g = rows.groupBy(length_band(F.col("text")).alias("band")).agg(F.count("*").alias("items"), F.round(F.avg("sarcastic_final"), 4).alias("sarcastic_share"), F.round(F.avg(F.col("split").cast("int")), 4).alias("split_share"))
    total = rows.agg(F.count("*").alias("_n"))
    return g.crossJoin(F.broadcast(total)).select("band", "items", F.round(F.col("items") / F.col("_n"), 4).alias("share"), "sarcastic_share", "split_share")  # one row


def page(rows: DataFrame, order: list[Column | str], number: int, size: int) -> DataFrame:
    """Page `number` from 1, under a total order."""
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def runs(manifests: DataFrame) -> DataFrame:
    """P19/O01."""
    short = F.when(F.length("collection_run_id") > 8, F.concat(F.substring("collection_run_id", 1, 8), F.lit("…"))).otherwise(F.col("collection_run_id"))
    return manifests.select(short.alias("run"), *(c for c in manifests.columns if c != "collection_run_id")).orderBy(F.desc("started_at_utc"))


def children_count(corpus: DataFrame) -> DataFrame:
    """A35."""
    return corpus.filter("parent_item IS NOT NULL").groupBy("parent_item").agg(F.count("*").alias("n_replies"))
