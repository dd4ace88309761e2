"""Vote aggregation (A11-A18, A34) as one grouped pass over the ratings and two left joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CUES, LABELS

THREE = LABELS[1:]


def vote_string(yes: Column, n: Column) -> Column:
    return F.concat_ws("-", F.greatest(yes, n - yes).cast("string"), F.least(yes, n - yes).cast("string"))


def sarcasm_final(yes: Column, n: Column, rule: str = "unanimous") -> Column:
    """NULL means escalate."""
    out = F.when((n >= 2) & ((yes == 0) | (yes == n)), (yes > 0).cast("int"))
    if rule == "majority":
        out = out.when((n >= 2) & (2 * yes != n), (2 * yes > n).cast("int"))
    return out


def majority_share(yes: Column, n: Column, shipped: Column) -> tuple[Column, Column]:
    """The annotators' majority (ties and no votes: the shipped label) and the share voting yes."""
    share = F.when(n > 0, F.round(yes / n, 4))
    return F.when((n > 0) & (2 * yes != n), 2 * yes > n).otherwise(shipped), share


def strict_majority(yes: Column, n: Column) -> Column:
    """NULL on a tie."""
    return F.when(2 * yes != n, (2 * yes > n).cast("int"))


def cue_majority(yes: Column, n: Column) -> Column:
    """More than half of the votes that are there."""
    return F.coalesce((2 * yes > n).cast("int"), F.lit(0))


def _values(label: str) -> Column:
    return F.transform("votes", lambda v: v[label])


def _ranked(label: str, top: bool) -> Column:
    """From the item's votes in lineup order: the value with most votes, first seen wins; or the most confident vote's value."""
    votes = F.filter("votes", lambda v: v[label].isNotNull())
    values = F.transform(votes, lambda v: v[label])
    if not top:
        best = F.transform(votes, lambda v: F.struct(F.coalesce(v["confidence"], F.lit(0.0)).alias("c"), (-v["pos"]).alias("p"), v[label].alias("x")))
        return F.array_max(best)["x"]
    count = lambda x: F.size(F.filter(values, lambda y: y == x))
    return F.array_max(F.transform(votes, lambda v: F.struct(count(v[label]).alias("n"), (-v["pos"]).alias("p"), v[label].alias("x"))))


def gathered(ratings: DataFrame, lineup: list[str], version: str) -> DataFrame:
    """One row an item: the lineup's votes in its order. At most len(lineup) votes an item, by the ratings' key."""
    order = F.array_position(F.array(*map(F.lit, lineup)), F.col("model_key")).cast("int") - 1
    mine = ratings.filter((F.col("prompt_version") == version) & (F.col("role") == "annotator") & F.col("model_key").isin(*lineup)).withColumn("pos", order)
    vote = F.struct("pos", "model_key", "sarcastic", *THREE, "confidence", *CUES)
    return mine.groupBy("item_id").agg(
        F.array_sort(F.collect_list(vote)).alias("votes"),
        F.count("*").alias("n_annotators"),
        F.count("sarcastic").alias("_n"),
        F.coalesce(F.sum("sarcastic"), F.lit(0)).alias("_yes"),
        *(F.sum(c).alias(f"_{c}") for c in CUES),
        *(F.count(c).alias(f"_n_{c}") for c in CUES),
    )


def label_outcome(label: str, tie_break: str) -> tuple[Column, Column, Column]:
    """Value, escalate, tie."""
    best = _ranked(label, True)
    has = F.coalesce(best["n"] >= 2, F.lit(False))
    tie = F.coalesce(best["n"] < 2, F.lit(False))
    if tie_break == "confidence":
        return F.when(has, best["x"]).otherwise(_ranked(label, False)), best.isNull(), tie
    return F.when(has, best["x"]), ~has, tie


def aggregate(ratings: DataFrame, reviews: DataFrame, lineup: list[str], version: str, rule: str = "unanimous", tie_break: str = "adjudicate", floor: float = 0.6) -> DataFrame:
    """One row for each item with a vote of the lineup."""
    g = gathered(ratings, lineup, version)
    g = g.withColumns({f"{x}_{k}": col for x in THREE for k, col in zip(("v", "e", "t"), label_outcome(x, tie_break), strict=True)})
    s = sarcasm_final(F.col("_yes"), F.col("_n"), rule)
    escalate = s.isNull() | F.col("language_e") | F.col("literal_sentiment_e") | F.col("intended_sentiment_e")
    same = lambda x: F.size(F.array_distinct(F.transform("votes", lambda v: v[x].cast("string")))) == 1
    agree = F.filter("votes", lambda v: v["confidence"].isNotNull() & (v["sarcastic"] == F.col("_s")))
    mean = F.when(F.size(agree) > 0, F.round(F.aggregate(agree, F.lit(0.0), lambda acc, v: acc + v["confidence"]) / F.size(agree), 4))
    g = g.withColumn("_s", s).withColumn("_escalate", escalate).withColumn("_unanimous", same("sarcastic") & same("language") & same("literal_sentiment") & same("intended_sentiment")).withColumn("_mean", mean)
    adj = ratings.filter((F.col("prompt_version") == version) & (F.col("role") == "adjudicator"))
    adj = adj.groupBy("item_id").agg(F.min(F.struct("model_key", "sarcastic", *THREE, "confidence", *CUES)).alias("adj"), F.array_sort(F.collect_list(F.struct("model_key", "sarcastic", *THREE, "confidence"))).alias("adj_all"))
    human = reviews.filter("is_gold = 0").select("item_id", F.struct("sarcastic", *THREE, *CUES).alias("human"))
    g = g.join(adj, "item_id", "left").join(human, "item_id", "left")
    by_adj, by_human = F.col("_escalate") & F.col("adj").isNotNull(), F.col("human").isNotNull()
    pick = lambda x, own: F.when(by_human, F.col("human")[x]).when(by_adj, F.col("adj")[x]).otherwise(own)
    resolved = F.when(by_human, "human").when(~F.col("_escalate"), F.when(F.col("_unanimous"), "unanimous").otherwise("majority")).when(by_adj, "adjudicator")
    adj_conf = F.round(F.col("adj")["confidence"], 4)
    return g.select(
        "item_id",
        F.lit(version).alias("prompt_version"),
        "n_annotators",
        vote_string(F.col("_yes"), F.col("_n")).alias("sarcasm_votes"),
        votes_json().alias("votes_json"),
        pick("sarcastic", F.col("_s")).cast("int").alias("sarcastic_final"),
        pick("language", F.col("language_v")).alias("language_final"),
        pick("literal_sentiment", F.col("literal_sentiment_v")).alias("literal_final"),
        pick("intended_sentiment", F.col("intended_sentiment_v")).alias("intended_final"),
        *(F.coalesce(F.when(by_human, F.coalesce(F.col("human")[c], F.lit(0))).when(by_adj, F.coalesce(F.col("adj")[c], F.lit(0))), cue_majority(F.col(f"_{c}"), F.col(f"_n_{c}"))).cast("int").alias(f"{c}_final") for c in CUES),
        F.col("_escalate").cast("int").alias("needs_adjudication"),
        (by_adj & ~by_human & F.coalesce(adj_conf < floor, F.lit(True))).cast("int").alias("needs_human"),
        resolved.alias("resolved_by"),
        F.when(~F.col("_escalate"), F.col("_mean")).when(by_adj, adj_conf).alias("mean_confidence"),
        (F.lit(0) if tie_break != "confidence" else sum((F.col(f"{x}_t").cast("int") for x in THREE), F.lit(0))).alias("tiebreak_labels"),
    )


def votes_json() -> Column:
    """The votes by model."""
    one = lambda v: F.struct(v["model_key"].alias("key"), F.struct((v["sarcastic"] != 0).alias("sarcastic"), *(v[x].alias(x) for x in THREE), v["confidence"].alias("confidence")).alias("value"))
    return F.to_json(F.map_from_entries(F.concat(F.transform("votes", one), F.transform(F.coalesce("adj_all", F.array()), one))))


def per_label_resolution(ratings: DataFrame, reviews: DataFrame, lineup: list[str], version: str, rule: str = "unanimous", tie_break: str = "adjudicate") -> DataFrame:
    """How each label was decided, seen on its own; an adjudicator's vote counts whether or not the item escalated."""
    g = gathered(ratings, lineup, version)
    adj = ratings.filter((F.col("prompt_version") == version) & (F.col("role") == "adjudicator")).select("item_id", F.lit(True).alias("_adj")).distinct()
    human = reviews.filter("is_gold = 0").select("item_id", F.lit(True).alias("_human"))
    g = g.join(adj, "item_id", "left").join(human, "item_id", "left")
    above = lambda own: F.when(F.col("_human"), "human").when(F.col("_adj"), "adjudicator").otherwise(own)
    s = sarcasm_final(F.col("_yes"), F.col("_n"), rule)
    out = [above(F.when(s.isNull(), "unresolved").when((F.col("_yes") == 0) | (F.col("_yes") == F.col("_n")), "unanimous").otherwise("majority")).alias("sarcastic")]
    for x in THREE:
        _, escalate, tie = label_outcome(x, tie_break)
        kinds = F.size(F.array_distinct(F.filter(_values(x), lambda y: y.isNotNull())))
        out.append(above(F.when(escalate, "unresolved").when(kinds == 1, "unanimous").when(tie, "tiebreak").otherwise("majority")).alias(x))
    return g.select("item_id", *out)


def outcome_stats(aggregates: DataFrame, escalated_adjudicated: str = "resolved_by") -> DataFrame:
    """A15's counters as a histogram of the resolution."""
    return aggregates.groupBy(F.coalesce(escalated_adjudicated, F.lit("unresolved")).alias("resolution")).agg(F.count("*").alias("n"))
