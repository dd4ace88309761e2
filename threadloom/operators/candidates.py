"""Candidate selection (F01-F08, F12, F19) and its counts (A04). Missing sets are anti joins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import PLACEHOLDER_BODIES, is_phatic, normalize, strip, tokens


@dataclass(frozen=True)
class Filters:
    min_chars: int = 12
    min_tokens: int = 3
    moderator_stickies_out: bool = True
    link_posts_in: bool = False
    phatic_out: bool = True
    phatic_max_tokens: int = 10
    phatic_max_leftover: int = 2


def exclusion_reason(norm: Column, f: Filters = Filters()) -> Column:
    """the first rule that holds, NULL if none. `norm` is the normalized text, other columns those of the corpus."""
    c = F.col
    out = F.when(c("is_bot") != 0, "bot_author")
    if f.moderator_stickies_out:
        out = out.when((c("distinguished") == "moderator") & (c("stickied") != 0), "moderator_sticky")
    out = out.when(c("author_status") == "deleted", "deleted_author")
    out = out.when(F.lower(strip(F.coalesce(c("text"), F.lit("")))).isin(*PLACEHOLDER_BODIES), "deleted_body")
    if not f.link_posts_in:
        out = out.when((c("record_type") == "submission") & (c("is_self") == 0) & (strip(F.coalesce(c("selftext"), F.lit(""))) == ""), "link_post")
    out = out.when(F.length(norm) < f.min_chars, "too_short").when(F.size(tokens(norm)) < f.min_tokens, "too_few_tokens")
    if f.phatic_out:
        out = out.when(is_phatic(norm, f.phatic_max_tokens, f.phatic_max_leftover), "phatic")
    return out


def select(corpus: DataFrame, votes: DataFrame | None = None, f: Filters = Filters()) -> DataFrame:
    """item_id, eligible, exclusion_reason, text_norm, phatic. A phatic item that an annotator has voted on stays eligible and is flagged."""
    rows = corpus.withColumn("text_norm", normalize(F.col("text")))
    rows = rows.select("item_id", "text_norm", exclusion_reason(F.col("text_norm"), f).alias("_why"))
    if votes is not None:
        voted = votes.filter("role = 'annotator'").select("item_id", F.lit(True).alias("_voted")).distinct()
        rows = rows.join(voted, "item_id", "left")
    else:
        rows = rows.withColumn("_voted", F.lit(None).cast("boolean"))
    phatic = F.coalesce(F.col("_why") == "phatic", F.lit(False))
    why = F.when(phatic & F.col("_voted").isNotNull(), F.lit(None)).otherwise(F.col("_why"))
    return rows.select("item_id", why.isNull().alias("eligible"), why.alias("exclusion_reason"), "text_norm", phatic.alias("phatic"))


def outcome_counts(candidates: DataFrame) -> DataFrame:
    """A04."""
    return candidates.groupBy(F.coalesce("exclusion_reason", F.lit("eligible")).alias("reason")).agg(F.count("*").alias("n"))


def missing(candidates: DataFrame, results: DataFrame) -> DataFrame:
    """eligible items without a result row."""
    return candidates.filter("eligible").select("item_id").join(results.select("item_id"), "item_id", "left_anti")


def pending_annotator(candidates: DataFrame, votes: DataFrame, failures: DataFrame, model: str, version: str, include_failed: bool = False) -> DataFrame:
    """F07."""
    mine = (F.col("model_key") == model) & (F.col("prompt_version") == version) & (F.col("role") == "annotator")
    out = candidates.filter("eligible").select("item_id").join(votes.filter(mine).select("item_id"), "item_id", "left_anti")
    return out if include_failed else out.join(failures.filter(mine).select("item_id"), "item_id", "left_anti")


def pending_adjudicator(aggregates: DataFrame, votes: DataFrame, failures: DataFrame, model: str, version: str, include_failed: bool = False) -> DataFrame:
    """escalated, not settled by a human, without an adjudicator's vote (any model) or failure (this model)."""
    open_ = aggregates.filter((F.col("needs_adjudication") == 1) & (F.coalesce("resolved_by", F.lit("")) != "human")).select("item_id")
    role = (F.col("prompt_version") == version) & (F.col("role") == "adjudicator")
    out = open_.join(votes.filter(role).select("item_id"), "item_id", "left_anti")
    return out if include_failed else out.join(failures.filter(role & (F.col("model_key") == model)).select("item_id"), "item_id", "left_anti")


def keyword_counts(corpus: DataFrame, keywords: list[str]) -> DataFrame:
    """for each marker, rows that hold it, by kind. One pass: each row is tested for all markers, then only hits are exploded."""
    hits = F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(F.lower(F.col("text")), k))
    return corpus.select("record_type", F.explode(hits).alias("keyword")).groupBy("keyword").agg(F.count_if(F.col("record_type") == "submission").alias("posts"), F.count_if(F.col("record_type") == "comment").alias("comments"))
