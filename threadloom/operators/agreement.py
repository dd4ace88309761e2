"""Agreement statistics (T01-T10) as closed forms over grouped counts; no rating matrix is ever built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import LABELS


def long_labels(ratings: DataFrame, lineup: list[str] | None, version: str) -> DataFrame:
    """T01 in long form: label, item_id, model_key, value; missing labels are absent rows."""
    mine = ratings.filter((F.col("prompt_version") == version) & (F.col("role") == "annotator"))
    if lineup is not None:
        mine = mine.filter(F.col("model_key").isin(*lineup))
    return mine.select("item_id", "model_key", *(F.col(x).cast("string").alias(x) for x in LABELS)).unpivot(["item_id", "model_key"], list(LABELS), "label", "value").filter("value IS NOT NULL")


def fleiss(labels: DataFrame) -> DataFrame:
    """Label, n_items, n_items_all_raters, fleiss_kappa over the items that every rater of the label's data has rated."""
    raters = labels.groupBy("label").agg(F.count_distinct("model_key").alias("k"))
    cells = labels.groupBy("label", "item_id", "value").agg(F.count("*").alias("n"))
    items = cells.groupBy("label", "item_id").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.col("n")).alias("sq"))
    whole = items.join(F.broadcast(raters), "label")  # one row a label
    full = whole.filter("m = k")
    agree = full.groupBy("label").agg(F.count("*").alias("n"), F.avg((F.col("sq") - F.col("k")) / F.nullif(F.col("k") * (F.col("k") - 1), F.lit(0))).alias("p"))
    share = cells.join(full.select("label", "item_id", "k"), ["label", "item_id"]).groupBy("label", "value", "k").agg(F.sum("n").alias("v"))
    share = share.join(agree.select("label", "n"), "label").groupBy("label").agg(F.sum(F.pow(F.col("v") / (F.col("n") * F.col("k")), 2)).alias("e"))
    kappa = F.when((F.col("n") >= 2) & (F.col("e") < 1), F.round((F.col("p") - F.col("e")) / (1 - F.col("e")), 4))
    totals = items.groupBy("label").agg(F.count("*").alias("n_items"))
    return totals.join(agree, "label", "left").join(share, "label", "left").select("label", "n_items", F.coalesce("n", F.lit(0)).alias("n_items_all_raters"), kappa.alias("fleiss_kappa"))


def krippendorff(labels: DataFrame) -> DataFrame:
    """T06 nominal: disagreement seen over disagreement expected, from per-item counts; items with one rating drop out."""
    cells = labels.groupBy("label", "item_id", "value").agg(F.count("*").alias("n"))
    items = cells.groupBy("label", "item_id").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.col("n")).alias("sq")).filter("m > 1")
    seen = items.groupBy("label").agg(F.sum((F.col("m") * F.col("m") - F.col("sq")) / (F.col("m") - 1)).alias("o"), F.sum("m").alias("total"))
    values = cells.join(items.select("label", "item_id"), ["label", "item_id"], "left_semi").groupBy("label", "value").agg(F.sum("n").alias("v"))
    expected = values.groupBy("label").agg(F.sum(F.col("v") * F.col("v")).alias("sq"))
    de = F.col("total") * F.col("total") - F.col("sq")
    alpha = F.when(de > 0, F.round(1 - F.col("o") * (F.col("total") - 1) / de, 4))
    many = labels.groupBy("label").agg(F.count_distinct("item_id").alias("n_items"))
    return many.join(seen.join(expected, "label"), "label", "left").select("label", F.when(F.col("n_items") >= 2, alpha).alias("krippendorff_alpha"))


def cohen(pairs: DataFrame, by: list[str], a: str = "a", b: str = "b", least: int = 1) -> DataFrame:
    """By, n, agree, kappa for any number of classes; NULL when chance agreement is whole or pairs are too few."""
    cells = pairs.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*by, F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("c"))
    left = cells.groupBy(*by, F.col("a").alias("v")).agg(F.sum("c").alias("x"))
    right = cells.groupBy(*by, F.col("b").alias("v")).agg(F.sum("c").alias("y"))
    chance = left.join(right, [*by, "v"]).groupBy(*by).agg(F.sum(F.col("x") * F.col("y")).alias("e"))
    seen = cells.groupBy(*by).agg(F.sum("c").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("c")).otherwise(0)).alias("agree"))
    n, e = F.col("n"), F.coalesce("e", F.lit(0))
    kappa = F.when((n >= least) & (e < n * n), F.round((F.col("agree") / n - e / (n * n)) / (1 - e / (n * n)), 4))
    return seen.join(chance, by, "left").select(*by, "n", "agree", kappa.alias("kappa"))


def binary_metrics(pairs: DataFrame, by: list[str], truth: str = "human", guess: str = "predicted") -> DataFrame:
    """N, accuracy, f1_sarcastic, kappa by group, over 0/1 columns."""
    t, g = F.col(truth), F.col(guess)
    m = pairs.groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if((t == 1) & (g == 1)).alias("tp"), F.count_if((t == 0) & (g == 1)).alias("fp"), F.count_if((t == 1) & (g == 0)).alias("fn"), F.count_if(t == g).alias("ok")
    )
    n, tp, fp, fn, ok = (F.col(x) for x in ("n", "tp", "fp", "fn", "ok"))
    chance = ((tp + fn) * (tp + fp) + (n - tp - fn) * (n - tp - fp)) / (n * n)
    return m.select(
        *by,
        "n",
        F.round(ok / n, 4).alias("accuracy"),
        F.round(2 * tp / F.nullif(2 * tp + fp + fn, F.lit(0)), 4).alias("f1_sarcastic"),
        F.when(chance < 1, F.round((ok / n - chance) / (1 - chance), 4)).alias("kappa"),
    )


def gold_labels(reviews: DataFrame) -> DataFrame:
    """F16: the blind labels of gold items: the stored first pass as a whole where there is one, else the row's own; items whose votes were seen first are out."""
    first = F.from_json("first_pass_json", "sarcastic int, language string, literal_sentiment string, intended_sentiment string")
    own = F.struct("sarcastic", "language", "literal_sentiment", "intended_sentiment")
    blind = reviews.filter((F.col("is_gold") != 0) & (F.coalesce("votes_seen", F.lit(0)) == 0))
    return blind.select("item_id", F.when(F.col("first_pass_json").isNotNull(), first).otherwise(own).alias("g")).select("item_id", "g.*")


def gold_kappa(reviews: DataFrame, aggregates: DataFrame) -> DataFrame:
    """Label, n, kappa of the blind gold labels against the final ones."""
    both = gold_labels(reviews).join(aggregates.select("item_id", "sarcastic_final", "language_final", "literal_final", "intended_final"), "item_id")
    pair = lambda x, y: F.struct(F.col(x).cast("string").alias("a"), F.col(y).cast("string").alias("b"))
    cols = {"sarcastic": "sarcastic_final", "language": "language_final", "literal_sentiment": "literal_final", "intended_sentiment": "intended_final"}
    rows = both.select(F.explode(F.array(*(F.struct(F.lit(k).alias("label"), pair(k, v).alias("p")) for k, v in cols.items()))).alias("r")).select("r.label", "r.p.a", "r.p.b")
    return cohen(rows, ["label"], least=2).drop("agree")


def lid_agreement(aggregates: DataFrame, lid: DataFrame) -> DataFrame:
    """T08/J08."""
    both = aggregates.filter("language_final IS NOT NULL").join(lid.select("item_id", "language"), "item_id")
    return both.agg(F.count("*").alias("n"), F.round(F.avg((F.col("language_final") == F.col("language")).cast("int")), 4).alias("agreement"))


def evaluation_report(gold: DataFrame, sources: DataFrame, kinds: DataFrame) -> DataFrame:
    """One row for each wanted source (source, kind), scored on the items shared with gold; sources without any have n = 0."""
    shared = sources.join(gold.filter("sarcastic IS NOT NULL").select("item_id", F.col("sarcastic").alias("human")), "item_id")
    scored = binary_metrics(shared.filter("predicted IS NOT NULL"), ["source"])
    return kinds.join(scored, "source", "left").select("source", "kind", F.coalesce("n", F.lit(0)).alias("n"), "accuracy", "f1_sarcastic", "kappa")


def report_markdown(rows: list[dict], version: str, n_gold: int, n_positive: int) -> str:
    """A small report's lines; `rows` are the collected rows of evaluation_report."""
    show = lambda x: "n/a" if x is None else f"{float(x):.3f}"
    head = [f"# Sarcasm against human gold ({version})", "", f"Gold items: {n_gold} ({n_positive} sarcastic).", "", "| Source | Kind | n | Accuracy | F1 | Kappa |", "|---|---|---:|---:|---:|---:|"]
    return "\n".join([*head, *(f"| {r['source']} | {r['kind']} | {r['n']} | {show(r['accuracy'])} | {show(r['f1_sarcastic'])} | {show(r['kappa'])} |" for r in rows)]) + "\n"
