"""Export rows, dumps and the dataset card."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CUES, LABELS
from ..sources.archive import zipped
from .candidates import outcome_counts
from .corpus import counts as corpus_counts
from .corpus import is_text_only
from .votes import majority_share

SHORT = {c: c.removeprefix("cue_") for c in CUES}


def _bool(c: str) -> Column:
    return F.col(c).cast("boolean")


def cues(suffix: str = "") -> Column:
    return F.struct(*(F.coalesce(_bool(c + suffix), F.lit(False)).alias(SHORT[c]) for c in CUES))


def vote_views(ratings: DataFrame, role: str, version: str, lineup: list[str] | None = None) -> DataFrame:
    """item_id, votes by model in name order, and the sarcasm counts."""
    rows = ratings.filter((F.col("prompt_version") == version) & (F.col("role") == role))
    if lineup is not None:
        rows = rows.filter(F.col("model_key").isin(*lineup))
    view = F.struct("model_key", _bool("sarcastic").alias("sarcastic"), *LABELS[1:], cues().alias("cues"), "confidence", "rationale")
    return rows.groupBy("item_id").agg(F.array_sort(F.collect_list(view)).alias("votes"), F.coalesce(F.sum("sarcastic"), F.lit(0)).alias("yes"), F.count("sarcastic").alias("n"))


def gate(aggregates: DataFrame, candidates: DataFrame, include_unresolved: bool = False) -> DataFrame:
    """F14."""
    rows = aggregates if include_unresolved else aggregates.filter("resolved_by IS NOT NULL")
    return rows.join(candidates.filter("eligible").select("item_id"), "item_id", "left_semi")


def _or_null(df: DataFrame, *names: str, kind: str = "string") -> list[Column]:
    return [F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c in names]


def human_view(reviews: DataFrame) -> DataFrame:
    """item_id, human_gold: a gold item's labels, notes, blind first pass, and what was on screen."""
    labels = lambda get: [get("sarcastic").cast("int").cast("boolean").alias("sarcastic"), *(get(c).alias(c) for c in LABELS[1:]), F.struct(*(F.coalesce(get(c).cast("int").cast("boolean"), F.lit(False)).alias(SHORT[c]) for c in CUES)).alias("cues")]
    first = F.from_json("first_pass_json", "sarcastic int, language string, literal_sentiment string, intended_sentiment string, " + ", ".join(f"{c} int" for c in CUES))
    full = reviews.select(*(c for c in reviews.columns if c not in ("notes", "first_pass_json")), *_or_null(reviews, "notes", "first_pass_json"))
    full = full.withColumn("_first", first)
    seen = lambda c: F.coalesce(F.col(c) != 0, F.lit(False)) if c in reviews.columns else F.lit(False)
    gold = F.struct(*labels(F.col), "notes", F.when(F.col("_first").isNotNull(), F.struct(*labels(lambda c: F.col(f"_first.{c}")))).alias("first_pass"), seen("assist_seen").alias("assist_seen"), seen("votes_seen").alias("votes_seen"))
    return full.filter("is_gold <> 0").select("item_id", gold.alias("human_gold"))


_NO_CONTEXT = "struct<source: string, submission: struct<item_id: string, author_hash: string, title: string, selftext: string>, parent_chain: array<struct<item_id: string, author_hash: string, is_submitter: int, depth: int, text: string>>, replies: array<struct<created_s: bigint, item_id: string, author_hash: string, is_submitter: int, depth: int, text: string>>>"


def rows(aggregates: DataFrame, corpus: DataFrame, ratings: DataFrame, resolution: DataFrame, lid: DataFrame, reviews: DataFrame, candidates: DataFrame, version: str, dataset_version: str, lineup: list[str], sentiment: DataFrame | None = None, snapshots: DataFrame | None = None) -> DataFrame:
    """The nested dataset rows. Each side is one row an item before it is joined; only named columns leave. `snapshots`
    (item_id, submission, parent_chain, replies) are the contexts that the votes were given on, never built anew here."""
    votes = vote_views(ratings, "annotator", version, lineup)
    adj = vote_views(ratings, "adjudicator", version).select("item_id", F.col("votes")[0].alias("adjudicator"))
    shipped = _bool("sarcastic_final")
    majority, share = majority_share(F.coalesce("yes", F.lit(0)), F.coalesce("n", F.lit(0)), shipped)
    lids = lid.select("item_id", F.struct(F.col("language").alias("auto_label"), "language", "en_ratio", "tl_ratio", "other_ratio", *_or_null(lid, "confidence", kind="double")).alias("lid"))
    per = resolution.select("item_id", F.struct(*LABELS).alias("per_label"))
    sides = [votes, adj, human_view(reviews), lids, per, candidates.select("item_id", "phatic")]
    if sentiment is not None:
        sides.append(sentiment.select("item_id", F.struct("label", "p_pos", "p_neu", "p_neg", *_or_null(sentiment, "model")).alias("tx_sentiment")))
    if snapshots is not None:
        sides.append(snapshots.select("item_id", F.struct(F.lit("annotator_snapshot").alias("source"), "submission", "parent_chain", "replies").alias("context")))
    names = ("permalink", "created_utc", "matched_query_or_keyword")
    whole = corpus.select("*", *(c for n, c in zip(names, _or_null(corpus, *names), strict=True) if n not in corpus.columns), *(c for n, c in zip(("score", "is_submitter"), _or_null(corpus, "score", "is_submitter", kind="long"), strict=True) if n not in corpus.columns))
    out = whole.join(aggregates.withColumnRenamed("prompt_version", "_pv"), "item_id")
    for side in sides:
        out = out.join(side, "item_id", "left")
    none = F.from_json(F.lit('{"source": "missing", "parent_chain": [], "replies": []}'), _NO_CONTEXT)
    context = F.coalesce(F.col("context"), none.cast(out.schema["context"].dataType)) if snapshots is not None else none
    sentiment_ = F.col("tx_sentiment") if sentiment is not None else F.lit(None).cast("struct<label: string, p_pos: double, p_neu: double, p_neg: double, model: string>")
    return out.select(
        "item_id", "record_type", "subreddit", "permalink", "created_utc", "created_s", "submission_item", "parent_item", "depth", "author_hash", "is_submitter", "score", "sampling_strategy", "matched_query_or_keyword",
        is_text_only(F.col("record_type"), F.col("is_self"), F.col("selftext")).alias("is_text_only"), "title", "selftext", "text",
        F.struct(shipped.alias("sarcastic"), majority.alias("sarcastic_majority"), share.alias("sarcasm_vote_share"), F.col("language_final").alias("language"), F.col("literal_final").alias("literal_sentiment"), F.col("intended_final").alias("intended_sentiment"), cues("_final").alias("cues")).alias("labels"),
        F.struct("resolved_by", "per_label", "sarcasm_votes", "n_annotators", "mean_confidence", _bool("needs_human").alias("needs_human"), F.col("votes").alias("annotators"), "adjudicator").alias("reliability"),
        "human_gold",
        F.struct(sentiment_.alias("tx_sentiment"), "lid").alias("aux"),
        context.alias("context"),
        F.struct(F.coalesce("phatic", F.lit(False)).alias("phatic")).alias("flags"),
        F.struct(F.col("_pv").alias("prompt_version"), F.lit(dataset_version).alias("dataset_version")).alias("provenance"),
    )


def flat(exported: DataFrame) -> DataFrame:
    """Scalars as they are, labels and cues as columns, other nested parts as JSON text."""
    plain = [F.col(n) for n, t in exported.dtypes if not t.startswith(("struct", "array", "map"))]
    label = exported.schema["labels"].dataType.names
    nested = [F.to_json(n).alias(f"{n}_json") for n, t in exported.dtypes if t.startswith(("struct", "array", "map")) and n != "labels"]
    return exported.select(*plain, *(F.col(f"labels.{n}").alias(f"label_{n}") for n in label if n != "cues"), *(F.col(f"labels.cues.{c}").alias(f"cue_{c}") for c in SHORT.values()), *nested)


def corpus_dump(corpus: DataFrame, exported: DataFrame, scope: str = "labeled_authors") -> DataFrame:
    """Exported rows and all rows of their authors; two semi joins, since a join on "or" would be a nested loop."""
    if scope == "all":
        return corpus
    if scope != "labeled_authors":
        raise ValueError(f"unknown scope {scope!r}")
    ids = exported.select("item_id").distinct()
    authors = corpus.join(ids, "item_id", "left_semi").filter("author_hash IS NOT NULL").select("author_hash").distinct()
    own = corpus.join(ids, "item_id", "left_semi")
    theirs = corpus.join(ids, "item_id", "left_anti").join(authors, "author_hash", "left_semi").select(*corpus.columns)
    return own.unionByName(theirs)


def distributions(exported: DataFrame) -> DataFrame:
    """Dim, value, n; all histograms in one pass: each row explodes to its values, partial sums do the rest."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    dims = {
        "sarcastic": F.col("labels.sarcastic"), "language": F.col("labels.language"), "literal_sentiment": F.col("labels.literal_sentiment"), "intended_sentiment": F.col("labels.intended_sentiment"),
        "resolved_by": F.col("reliability.resolved_by"), "subreddit": F.col("subreddit"), "record_type": F.col("record_type"), "sampling_strategy": F.col("sampling_strategy"), "is_text_only": F.col("is_text_only"),
        "sarcastic_by_language": F.concat(text(F.col("labels.language")), F.lit("|sarcastic="), text(F.col("labels.sarcastic"))), "sarcastic_per_label_resolution": F.col("reliability.per_label.sarcastic"),
    }
    cells = F.array(*(F.struct(F.lit(k).alias("dim"), text(v).alias("value")) for k, v in dims.items()))
    return exported.select(F.explode(cells).alias("x")).groupBy(F.col("x.dim").alias("dim"), F.col("x.value").alias("value")).agg(F.count("*").alias("n"))


def label_sets(exported: DataFrame) -> DataFrame:
    """Shipped against majority label."""
    a, b = F.col("labels.sarcastic"), F.col("labels.sarcastic_majority")
    m = exported.filter(a.isNotNull() & b.isNotNull()).agg(F.count("*").alias("n"), F.count_if(a).alias("x"), F.count_if(b).alias("y"), F.count_if(a & b).alias("both"), F.count_if(a == b).alias("agree"))
    n, x, y = F.col("n"), F.col("x"), F.col("y")
    chance = (x * y + (n - x) * (n - y)) / F.nullif(n * n, F.lit(0))
    return m.select("n", x.alias("shipped_positives"), y.alias("majority_positives"), F.col("both").alias("both_positive"), (n - F.col("agree")).alias("rows_that_differ"), F.when(chance < 1, F.round((F.col("agree") / n - chance) / (1 - chance), 4)).alias("kappa"))


def readiness(exported: DataFrame) -> DataFrame:
    """A21."""
    cells = exported.groupBy("labels.language", "labels.sarcastic").agg(F.count("*").alias("n"))
    return cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("exported_rows"), F.coalesce(F.sum(F.when(F.col("sarcastic"), F.col("n")).otherwise(0)), F.lit(0)).alias("sarcastic_positives"), F.coalesce(F.min("n"), F.lit(0)).alias("min_language_x_sarcastic_cell"))


def collection_window(corpus: DataFrame, exported: DataFrame, created: str = "created_utc") -> DataFrame:
    """First and last time of the corpus (from 2000 on) and of the exported rows."""
    whole = corpus.agg(F.min(F.when(F.col(created) >= "2000", F.col(created))).alias("corpus_from"), F.max(F.when(F.col(created) >= "2000", F.col(created))).alias("corpus_to"))
    mine = corpus.join(exported.select("item_id"), "item_id", "left_semi").agg(F.min(created).alias("exported_from"), F.max(created).alias("exported_to"))
    return whole.crossJoin(mine)  # one row each


def provenance(ratings: DataFrame) -> DataFrame:
    """A10: counts by model, role, version, endpoint and digest."""
    keys = ["model_key", "role", "prompt_version", "endpoint", "model_digest"]
    return ratings.select(*_or_null(ratings, *keys)).groupBy(*keys).agg(F.count("*").alias("n"))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """Name and SHA-256 of each file of a folder; read whole, so for artifacts, not for data."""
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"))


def card(exported: DataFrame, corpus: DataFrame, ratings: DataFrame, candidates: DataFrame, dataset_version: str, version: str, created_at: str, more: dict | None = None) -> dict:
    """The card's numbers in one document. Every part is a few rows, whatever the data; `more` adds parts that other operators
    compute (agreement, coverage, what was skipped, how votes are combined)."""
    one = lambda df: df.first().asDict(recursive=True)
    spread: dict[str, dict] = {}
    for r in distributions(exported).collect():  # values of a few closed lists, and subreddits
        spread.setdefault(r["dim"], {})[r["value"]] = r["n"]
    created = "created_utc" if "created_utc" in corpus.columns else None
    counts = {
        "corpus": one(corpus_counts(corpus)),
        "candidates": {r["reason"]: r["n"] for r in outcome_counts(candidates).collect()} if "exclusion_reason" in candidates.columns else {"eligible": candidates.filter("eligible").count()},
        "exported_rows": exported.count(),
        "phatic_flagged_rows": exported.filter("flags.phatic").count(),
    }
    out = {
        "dataset_version": dataset_version, "prompt_version": version, "created_at": created_at, "counts": counts, "label_sets": one(label_sets(exported)), "label_distributions": spread, "readiness": one(readiness(exported)),
        "collection_window": one(collection_window(corpus, exported)) if created else None, "annotator_provenance": [r.asDict() for r in provenance(ratings.filter(F.col("prompt_version") == version)).orderBy("model_key", "role").collect()],
    }
    return out | (more or {})


def _files(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def put(spark: SparkSession, folder: str, name: str, content: bytes) -> None:
    """One file of a folder, replaced at once: written beside it, then renamed."""
    jvm = spark.sparkContext._jvm
    fs, top = _files(spark, folder)
    fs.mkdirs(top)
    new, old = jvm.org.apache.hadoop.fs.Path(top, f".{name}.new"), jvm.org.apache.hadoop.fs.Path(top, name)
    out = fs.create(new, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    fs.delete(old, False)
    fs.rename(new, old)


def write_card(spark: SparkSession, folder: str, document: dict) -> None:
    """The latest card under its fixed name, and each version's beside it."""
    text = json.dumps(document, indent=2, ensure_ascii=False, default=str).encode()
    for name in ("dataset_card.json", f"dataset_card-{document['dataset_version']}.json"):
        put(spark, folder, name, text)


def bundle(spark: SparkSession, folder: str, to: str, dataset_version: str) -> str:
    """All files below a folder in one zip with SHA256SUMS.txt."""
    return zipped(spark, folder, f"{to.rstrip('/')}/dataset-{dataset_version}.zip")


def newest_bundle(spark: SparkSession, folder: str) -> str | None:
    """The bundle written last, if there is any."""
    fs, top = _files(spark, folder)
    found = [x for x in fs.listStatus(top) if x.getPath().getName().startswith("dataset-") and x.getPath().getName().endswith(".zip")] if fs.exists(top) else []
    return max(found, key=lambda x: (x.getModificationTime(), x.getPath().getName())).getPath().toString() if found else None


def write_bundle(exported: DataFrame, path: str) -> None:
    """JSON lines, Parquet and the card's numbers, side by side under one folder; Spark's committer makes each whole or absent."""
    exported.write.mode("overwrite").json(f"{path}/dataset_json")
    flat(exported).write.mode("overwrite").parquet(f"{path}/dataset_parquet")
    distributions(exported).coalesce(1).write.mode("overwrite").json(f"{path}/card_distributions")
    label_sets(exported).coalesce(1).write.mode("overwrite").json(f"{path}/card_label_sets")
    readiness(exported).coalesce(1).write.mode("overwrite").json(f"{path}/card_readiness")
