"""Target set and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _annotators(votes: DataFrame, version: str) -> DataFrame:
    return votes.filter((F.col("prompt_version") == version) & (F.col("role") == "annotator"))


def target_set(candidates: DataFrame, votes: DataFrame, priority: DataFrame, version: str, n: int) -> DataFrame:
    """item_id, prio, n_votes of the first n eligible items by priority, then votes, then id. The limit is a top-k, never a full sort."""
    counts = _annotators(votes, version).groupBy("item_id").agg(F.count("*").alias("n_votes"))
    ranked = candidates.filter("eligible").select("item_id").join(priority.select("item_id", "priority"), "item_id", "left").join(counts, "item_id", "left")
    ranked = ranked.select("item_id", F.coalesce("priority", F.lit(0)).alias("prio"), F.coalesce("n_votes", F.lit(0)).alias("n_votes"))
    return ranked.orderBy(F.desc("prio"), F.desc("n_votes"), "item_id").limit(n)


def pending_in_target(target: DataFrame, votes: DataFrame, failures: DataFrame, model: str, version: str, include_failed: bool = False) -> DataFrame:
    """The target is cut first, then what the model has done (or failed) is taken out."""
    mine = F.col("model_key") == model
    out = target.join(_annotators(votes, version).filter(mine).select("item_id"), "item_id", "left_anti")
    return out if include_failed else out.join(_annotators(failures, version).filter(mine).select("item_id"), "item_id", "left_anti")


def missing_in_target(target: DataFrame, results: DataFrame) -> DataFrame:
    """W03."""
    return target.join(results.select("item_id"), "item_id", "left_anti")


def progress(target: DataFrame, votes: DataFrame, failures: DataFrame, models: DataFrame, version: str) -> DataFrame:
    """A07 by model: in_target, done, failed, pending. `models` has model_key; failures count items once."""
    ids = target.select("item_id")
    done = _annotators(votes, version).join(ids, "item_id", "left_semi").groupBy("model_key").agg(F.count("*").alias("done"))
    failed = _annotators(failures, version).join(ids, "item_id", "left_semi").groupBy("model_key").agg(F.count_distinct("item_id").alias("failed"))
    total = ids.agg(F.count("*").alias("in_target"))
    out = models.join(done, "model_key", "left").join(failed, "model_key", "left").crossJoin(F.broadcast(total))  # one row
    d, f = F.coalesce("done", F.lit(0)), F.coalesce("failed", F.lit(0))
    return out.select("model_key", "in_target", d.alias("done"), f.alias("failed"), F.greatest(F.lit(0), F.col("in_target") - d - f).alias("pending"))


def complete(target: DataFrame, votes: DataFrame, lineup: list[str], version: str) -> DataFrame:
    """Items of the target that every model of the lineup has voted on."""
    mine = _annotators(votes, version).filter(F.col("model_key").isin(*lineup)).join(target.select("item_id"), "item_id", "left_semi")
    return mine.groupBy("item_id").agg(F.count_distinct("model_key").alias("k")).filter(F.col("k") == len(lineup)).agg(F.count("*").alias("complete"))


def model_progress(votes: DataFrame, version: str) -> DataFrame:
    """A05."""
    return votes.filter(F.col("prompt_version") == version).groupBy("model_key", "role").agg(F.count("*").alias("done"), F.avg("duration_ms").alias("avg_ms"))


def failure_counts(failures: DataFrame, version: str) -> DataFrame:
    """A06."""
    return failures.filter(F.col("prompt_version") == version).groupBy("model_key", "role").agg(F.count_distinct("item_id").alias("failed"))


def annotated_items(votes: DataFrame, version: str) -> DataFrame:
    """A26."""
    return _annotators(votes, version).select("item_id").distinct()


def status(models: DataFrame, votes: DataFrame, failures: DataFrame, eligible: DataFrame, version: str) -> DataFrame:
    """One row for each configured (model_key, role, pos), even without any vote; adjudicators have no pending count."""
    keys = ["model_key", "role"]
    out = models.join(model_progress(votes, version), keys, "left").join(failure_counts(failures, version), keys, "left").crossJoin(F.broadcast(eligible.agg(F.count("*").alias("_all"))))
    done = F.coalesce("done", F.lit(0))
    return out.select(*keys, done.alias("done"), F.coalesce("failed", F.lit(0)).alias("failed"), F.when(F.col("role") == "annotator", F.greatest(F.lit(0), F.col("_all") - done)).alias("pending"), F.round(F.col("avg_ms") / 1000, 2).alias("avg_s"))


def least_done_first(models: DataFrame, votes: DataFrame, version: str) -> DataFrame:
    """Models with `pos`, fewest votes first, ties in configured order."""
    done = _annotators(votes, version).groupBy("model_key").agg(F.count("*").alias("done"))
    return models.join(done, "model_key", "left").select("model_key", "pos", F.coalesce("done", F.lit(0)).alias("done")).orderBy("done", "pos")
