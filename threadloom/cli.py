"""The commands, each a call of engine functions over the tables of a workspace.

    python -m threadloom.cli WORKSPACE COMMAND [options]
"""

from __future__ import annotations

import argparse
import json
import os
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import identity
from .operators import agreement, candidates, corpus, export, language, review, state, target, threads, views, votes
from .schemas import CUES, RATING
from .sources import files, lines
from .workspace import Workspace

_RATINGS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RATING)
_LABEL_COLS = "sarcastic int, language string, literal_sentiment string, intended_sentiment string, " + ", ".join(f"{c} int" for c in CUES)
LIKE = {
    "ratings": _RATINGS,
    "evaluations": _RATINGS,
    "failures": "item_id string, model_key string, prompt_version string, role string, error string",
    "reviews": f"item_id string, {_LABEL_COLS}, sarcastic_span string, unsure int, notes string, is_gold int, first_pass_json string, assist_seen int, votes_seen int, first_reviewed_at string, reviewed_at string",
    "queue": "item_id string, reason string, completed int",
    "lid": "item_id string, language string, en_ratio double, tl_ratio double, other_ratio double",
    "priority": "item_id string, priority int",
    "suggestions": "item_id string, confidence double, sarcastic_span string",
}
COMMANDS: dict[str, Callable[[Workspace, argparse.Namespace], DataFrame | None]] = {}


def command(f):
    COMMANDS[f.__name__.replace("_", "-")] = f
    return f


def key() -> bytes | None:
    """The pseudonym key comes from the environment; without one, names can't be hashed and nothing is written."""
    value = os.environ.get("AUTHOR_HMAC_KEY")
    return value.encode() if value else None


def _lineup(a: argparse.Namespace) -> list[str]:
    return a.lineup.split(",")


@command
def collect(w: Workspace, a: argparse.Namespace) -> DataFrame:
    """Raw rows (JSON lines) to records: normalized, pseudonymized, merged by key into the records table."""
    if key() is None:
        raise SystemExit("AUTHOR_HMAC_KEY is not set")
    raw = files.jsonl(w.spark, a.input).filter("NOT bad").drop("bad", "_file", "item_id")
    fresh = corpus.normalized(raw, a.run, key(), a.sampling, a.keyword).withColumn("record_key", identity.record_identity(F.col("reddit_fullname"), F.col("record_type"), F.col("reddit_id"), F.col("id")))
    old = w.table("records") if w.has("records") else fresh.limit(0)
    return w.save("records", state.insert_new(old, fresh, ["record_key"])).groupBy("record_type").agg(F.count("*").alias("n"))


@command
def validate_fixtures(w: Workspace, a: argparse.Namespace) -> DataFrame:
    return files.fixture_errors(files.fixture(w.spark, a.input), strict=a.strict).filter(F.size("errors") > 0).select("record_type", "name", "errors")


@command
def index(w: Workspace, a: argparse.Namespace) -> DataFrame:
    records = w.table("records").withColumn("author", F.lit(None).cast("string"))
    rows = corpus.index(records, key()).withColumn("created_s", F.unix_seconds("ts"))
    return corpus.counts(w.save("corpus", corpus.inherit_sampling(rows)))


@command
def retag_calendar_walk(w: Workspace, a: argparse.Namespace) -> DataFrame:
    out = state.retag(w.table("records"))
    counted = out.filter("retagged").groupBy("collection_run_id").agg(F.count("*").alias("n")).collect()
    w.save("records", out.drop("retagged"))
    return w.spark.createDataFrame(counted, "collection_run_id string, n long")


@command
def scrub_authors(w: Workspace, a: argparse.Namespace) -> DataFrame:
    return w.save("records", state.scrub(w.table("records"))).agg(F.count("*").alias("records"))


@command
def scrub_files(w: Workspace, a: argparse.Namespace) -> DataFrame:
    """Names out of the JSON lines below a folder, in place; files without any are not touched."""
    done = lines.rewrite(w.spark, a.input, lines.edited(lines.lines(w.spark, a.input), lines.without_author))
    return w.spark.createDataFrame([(len(done),)], "files int")


@command
def retag_files(w: Workspace, a: argparse.Namespace) -> DataFrame:
    """The calendar walk's tags in the JSON lines below a folder, in place."""
    done = lines.rewrite(w.spark, a.input, lines.edited(lines.lines(w.spark, a.input), lines.retagged))
    return w.spark.createDataFrame([(len(done),)], "files int")


@command
def select(w: Workspace, a: argparse.Namespace) -> DataFrame:
    return candidates.outcome_counts(w.save("candidates", candidates.select(w.table("corpus"), w.table("ratings", LIKE["ratings"]))))


@command
def lid(w: Workspace, a: argparse.Namespace) -> DataFrame:
    old = w.table("lid", LIKE["lid"])
    new = language.run(w.table("corpus"), w.table("candidates"), None if a.force else old)
    return w.save("lid", new if a.force else old.unionByName(new)).groupBy("language").agg(F.count("*").alias("n"))


@command
def contexts(w: Workspace, a: argparse.Namespace) -> DataFrame:
    wanted = w.table("candidates").filter("eligible").select("item_id")
    old = w.table("contexts", "item_id string, prompt_version string, context_text string")
    made = threads.reuse(old, w.table("corpus"), wanted, a.version).withColumn("prompt_version", F.lit(a.version))
    return w.save("contexts", made.select("item_id", "prompt_version", "context_text")).agg(F.count("*").alias("contexts"))


@command
def load_votes(w: Workspace, a: argparse.Namespace) -> DataFrame:
    """Votes as JSON lines; a vote given before stays as it was."""
    new = w.spark.read.schema(RATING).json(a.input)
    keys = ["item_id", "model_key", "prompt_version", "role"]
    return w.save(a.into, state.insert_new(w.table(a.into, LIKE["ratings"]), new, keys)).groupBy("model_key", "role").agg(F.count("*").alias("n"))


@command
def load_reviews(w: Workspace, a: argparse.Namespace) -> DataFrame:
    new = w.spark.read.schema(LIKE["reviews"]).json(a.input)
    old = w.table("reviews", LIKE["reviews"])
    saved = review.save_reviews(new, old).withColumn("reviewed_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
    saved = saved.withColumn("first_reviewed_at", F.coalesce("first_reviewed_at", "reviewed_at"))
    reviews = w.save("reviews", state.upsert(old, saved.select(*old.columns), ["item_id"]))
    return review.queue_counts(w.save("queue", state.completed(w.table("queue", LIKE["queue"]), reviews)))


@command
def load_assist(w: Workspace, a: argparse.Namespace) -> DataFrame:
    """All or nothing."""
    lines = review.assist_errors(w.spark.read.schema(LIKE["suggestions"]).json(a.input), w.table("corpus"))
    wrong = lines.filter(F.size("errors") > 0).select("item_id", "errors")
    if wrong.limit(1).count():
        return wrong
    return w.save("suggestions", state.upsert(w.table("suggestions", LIKE["suggestions"]), lines.drop("errors"), ["item_id"])).agg(F.count("*").alias("suggestions"))


@command
def aggregate(w: Workspace, a: argparse.Namespace) -> DataFrame:
    got = w.save("aggregates", votes.aggregate(w.table("ratings"), w.table("reviews", LIKE["reviews"]), _lineup(a), a.version, a.rule, a.tie_break))
    low = got.filter("needs_human = 1").select("item_id", F.lit("low_confidence").alias("reason"), F.lit(0).alias("completed"))
    w.save("queue", state.insert_new(w.table("queue", LIKE["queue"]), low, ["item_id"]))
    return votes.outcome_stats(got)


@command
def agreement_report(w: Workspace, a: argparse.Namespace) -> DataFrame:
    labels = agreement.long_labels(w.table("ratings"), _lineup(a), a.version)
    gold = agreement.gold_kappa(w.table("reviews", LIKE["reviews"]), w.table("aggregates")).select("label", F.col("n").alias("n_gold"), F.col("kappa").alias("gold_kappa"))
    return agreement.fleiss(labels).join(agreement.krippendorff(labels), "label", "left").join(gold, "label", "left")


@command
def eval_report(w: Workspace, a: argparse.Namespace) -> DataFrame:
    """Evaluator votes stay in a table of their own and are only ever compared."""
    base = w.table("ratings").filter("role = 'annotator'")
    major = base.groupBy("item_id").agg(votes.strict_majority(F.sum("sarcastic"), F.count("sarcastic")).alias("predicted")).filter("predicted IS NOT NULL").select(F.lit("annotator majority").alias("source"), "item_id", "predicted")
    final = w.table("aggregates").filter("sarcastic_final IS NOT NULL").select(F.lit("shipped final").alias("source"), "item_id", F.col("sarcastic_final").alias("predicted"))
    own = lambda df: df.filter("sarcastic IS NOT NULL").select(F.col("model_key").alias("source"), "item_id", F.col("sarcastic").alias("predicted"))
    judges = own(w.table("evaluations", LIKE["evaluations"]))
    kinds = [(m, "annotator") for m in _lineup(a)] + [("annotator majority", "majority"), ("shipped final", "final")]
    kinds += [(r[0], "evaluator") for r in judges.select("source").distinct().collect()]  # one row a configured model
    return agreement.evaluation_report(agreement.gold_labels(w.table("reviews", LIKE["reviews"])), own(base).unionByName(major).unionByName(final).unionByName(judges), w.spark.createDataFrame(kinds, "source string, kind string"))


@command
def gold_sample(w: Workspace, a: argparse.Namespace) -> DataFrame:
    queue = w.table("queue", LIKE["queue"])
    queue = review.redraw(queue) if a.redraw else queue
    kept = queue.filter("reason = 'gold'").count()
    pop = review.gold_population(w.table("aggregates"), w.table("corpus"), w.table("candidates"), queue)
    drawn = review.gold_sample(pop, max(0, a.size - kept), a.seed).select("item_id", F.lit("gold").alias("reason"), F.lit(0).alias("completed"))
    return review.queue_counts(w.save("queue", queue.unionByName(drawn)))


@command
def fork(w: Workspace, a: argparse.Namespace) -> DataFrame:
    month = w.table("corpus").join(w.table("candidates").filter("eligible").select("item_id"), "item_id", "left_semi").select("item_id", F.date_format("ts", "yyyy-MM").alias("month"))
    taken = w.table("aggregates").select("item_id")
    more = state.extension_sample(month, taken, state.parse_extend(a.extend), a.seed)
    out = Workspace(w.spark, a.to)
    for name, df in state.fork(w.table("ratings"), w.table("aggregates"), w.table("queue", LIKE["queue"]), more, _lineup(a), a.version).items():
        out.save("priority" if name == "target_priority" else name, df)
    for name in ("corpus", "candidates", "reviews", "lid", "contexts"):
        if w.has(name):
            out.save(name, w.table(name))
    return out.table("priority").groupBy("priority").agg(F.count("*").alias("n"))


@command
def status(w: Workspace, a: argparse.Namespace) -> DataFrame:
    models = w.spark.createDataFrame([(m, "annotator") for m in _lineup(a)] + [("senior", "adjudicator")], "model_key string, role string")
    ratings = w.table("ratings", LIKE["ratings"])
    ratings = ratings if "duration_ms" in ratings.columns else ratings.withColumn("duration_ms", F.lit(None).cast("long"))
    return target.status(models, ratings, w.table("failures", LIKE["failures"]), w.table("candidates").filter("eligible"), a.version)


@command
def target_progress(w: Workspace, a: argparse.Namespace) -> DataFrame:
    ratings = w.table("ratings", LIKE["ratings"])
    chosen = target.target_set(w.table("candidates"), ratings, w.table("priority", LIKE["priority"]), a.version, a.size)
    return target.progress(chosen, ratings, w.table("failures", LIKE["failures"]), w.spark.createDataFrame([(m,) for m in _lineup(a)], "model_key string"), a.version)


@command
def runs(w: Workspace, a: argparse.Namespace) -> DataFrame:
    return views.runs(files.manifests(w.spark, a.input))


@command
def export_dataset(w: Workspace, a: argparse.Namespace) -> DataFrame:
    c, r, h = w.table("corpus"), w.table("ratings"), w.table("reviews", LIKE["reviews"])
    per = votes.per_label_resolution(r, h, _lineup(a), a.version, a.rule, a.tie_break)
    rows = w.save("dataset", export.rows(export.gate(w.table("aggregates"), w.table("candidates"), a.include_unresolved), c, r, per, w.table("lid", LIKE["lid"]), h, w.table("candidates"), a.version, a.dataset_version, _lineup(a), snapshots=w.table("contexts") if w.has("contexts") and "parent_chain" in w.table("contexts").columns else None))
    folder = f"{a.to}/{a.dataset_version}"
    export.write_bundle(rows, folder)
    export.write_card(w.spark, folder, export.card(rows, c, r, w.table("candidates"), a.dataset_version, a.version, datetime.now(UTC).isoformat()))
    export.corpus_dump(c, rows.select("item_id"), a.scope).write.mode("overwrite").json(f"{a.to}/{a.dataset_version}/corpus_json")
    export.bundle(w.spark, folder, a.to, a.dataset_version)
    return export.readiness(rows)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="threadloom", description=__doc__)
    p.add_argument("workspace")
    p.add_argument("command", choices=sorted(COMMANDS))
    p.add_argument("--input")
    p.add_argument("--to")
    p.add_argument("--into", default="ratings", choices=("ratings", "evaluations"))
    p.add_argument("--run", default="run")
    p.add_argument("--sampling", default="natural")
    p.add_argument("--keyword")
    p.add_argument("--lineup", default="a1,a2,a3")
    p.add_argument("--version", default="v1")
    p.add_argument("--dataset-version", default="1")
    p.add_argument("--rule", default="unanimous", choices=("unanimous", "majority"))
    p.add_argument("--tie-break", default="adjudicate", choices=("adjudicate", "confidence"))
    p.add_argument("--scope", default="labeled_authors", choices=("labeled_authors", "all"))
    p.add_argument("--extend", default="")
    p.add_argument("--size", type=int, default=300)
    p.add_argument("--seed", type=int, default=7)
    for flag in ("--force", "--strict", "--redraw", "--include-unresolved"):
        p.add_argument(flag, action="store_true")
    return p


def run(spark: SparkSession, argv: list[str]) -> list[dict]:
    a = parser().parse_args(argv)
    got = COMMANDS[a.command](Workspace(spark, a.workspace), a)
    return [r.asDict(recursive=True) for r in got.collect()] if got is not None else []


def main() -> None:
    import sys

    spark = SparkSession.builder.appName("threadloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    for row in run(spark, sys.argv[1:]):
        print(json.dumps(row, default=str))


if __name__ == "__main__":
    main()
