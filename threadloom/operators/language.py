"""Word-list language identification (U01, U02) and pluggable scorers."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import json_object, rounded, tokens
from ..schemas import CUES, DOMAINS

# Function words of the two languages.
TAGALOG = (
    "ang ng mga sa si sina ni nina kay kina ay at o pero kasi dahil para kung ako ikaw ka siya kami tayo kayo sila ko mo niya "
    "namin natin ninyo nila akin iyo kanya amin atin inyo kanila ito iyan iyon dito diyan doon hindi wag huwag oo opo po ho ba "
    "naman lang nga pala daw raw din rin na pa may mayroon meron wala sana talaga sobra grabe yung yun yan eh edi pano paano "
    "bakit saan kailan sino ano alin gusto ayaw pwede puwede masyado medyo halos lagi minsan ngayon kanina bukas kahapon mamaya"
).split()
ENGLISH = (
    "the a an and or but if of to in on at for with is are was were be been am i you he she it we they my your his her its our "
    "their this that these those not no yes do does did have has had will would can could should really"
).split()


def identify(text: Column, threshold: float = 0.9, message_label: Column | None = None, word_label: Callable[[Column], Column] | None = None) -> Column:
    """struct(language, en_ratio, tl_ratio, other_ratio). `word_label` gives en, tl or other for words outside the lists (a model's column; other without one); `message_label` counts only for texts without any word."""
    words = F.transform(tokens(F.coalesce(text, F.lit(""))), F.lower)
    empty = F.when(message_label == "en", "english").when(message_label == "tl", "tagalog").otherwise("taglish") if message_label is not None else F.lit("taglish")

    # one walk over the words adds up both kinds in one number, so that a word is looked up once; the others are the rest
    en_one = 1 << 32
    one = lambda kind: F.when(kind == "tl", 1).when(kind == "en", en_one).otherwise(0).cast("long")

    def count(acc: Column, w: Column) -> Column:
        return acc + F.when(w.isin(*TAGALOG), F.lit(1).cast("long")).when(w.isin(*ENGLISH), F.lit(en_one)).otherwise(one(word_label(w)) if word_label else F.lit(0).cast("long"))

    counted = lambda words: F.struct(F.size(words).alias("n"), F.aggregate(words, F.lit(0).cast("long"), count).alias("c"))

    def finish(x: Column) -> Column:
        n, tl, en = x["n"], x["c"].bitwiseAND(F.lit(en_one - 1)), F.shiftright(x["c"], 32)
        share = lambda k: k / F.greatest(F.lit(1), n)
        language = F.when(n == 0, empty).when(share(en) >= threshold, "english").when(share(tl) >= threshold, "tagalog").otherwise("taglish")
        return F.struct(language.alias("language"), *(rounded(share(k)).alias(f"{name}_ratio") for k, name in ((en, "en"), (tl, "tl"), (n - en - tl, "other"))))

    return F.transform(F.transform(F.array(words), counted), finish)[0]  # so the words are made once


def run(corpus: DataFrame, candidates: DataFrame, results: DataFrame | None = None) -> DataFrame:
    """Results for eligible items that have none."""
    todo = candidates.filter("eligible").select("item_id")
    if results is not None:
        todo = todo.join(results.select("item_id"), "item_id", "left_anti")
    return corpus.join(todo, "item_id", "left_semi").select("item_id", identify(F.col("text")).alias("r")).select("item_id", "r.*")


def sentiment(rows: DataFrame, scorer: Callable[[list[str]], list[tuple[float, float, float]]], text: str = "text") -> DataFrame:
    """item_id, label, p_pos, p_neu, p_neg from any batch scorer; loaded once a task, fed Arrow batches."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = pd.DataFrame(scorer(b[text].fillna("").tolist()), columns=["p_pos", "p_neu", "p_neg"]).round(4)
            names = p.idxmax(axis=1).map({"p_pos": "positive", "p_neu": "neutral", "p_neg": "negative"}) if len(p) else []
            yield p.assign(item_id=b["item_id"].to_numpy(), label=names)[["item_id", "label", "p_pos", "p_neu", "p_neg"]]

    return rows.select("item_id", text).mapInPandas(score, "item_id string, label string, p_pos double, p_neu double, p_neg double")


ANSWER = "language string, literal_sentiment string, intended_sentiment string, sarcastic boolean, confidence double, rationale string, cues struct<polarity_inversion: boolean, rhetorical_intent: boolean, contextual_incongruity: boolean, hyperbole: boolean>"


def parse_answers(raw: DataFrame, answer: str = "answer") -> DataFrame:
    """Votes from a model's answers; `error` says why there is none."""
    got = raw.withColumn("a", F.from_json(json_object(F.col(answer)), ANSWER))
    wrong = F.array_compact(F.array(F.when(F.col("a").isNull() | F.col("a.sarcastic").isNull(), "sarcastic"), *(F.when(~F.coalesce(F.col(f"a.{k}").isin(*v), F.lit(False)), k) for k, v in DOMAINS.items() if k != "sarcastic"), F.when(~F.coalesce(F.col("a.confidence").between(0, 1), F.lit(False)), "confidence")))
    bad = F.size(wrong) > 0
    keep = lambda c: F.when(~bad, c)
    return got.select(
        *(c for c in raw.columns if c != answer), *(keep(F.col(f"a.{k}")).alias(k) for k in DOMAINS if k != "sarcastic"), keep(F.col("a.sarcastic").cast("int")).alias("sarcastic"),
        *(keep(F.coalesce(F.col(f"a.cues.{c.removeprefix('cue_')}").cast("int"), F.lit(0))).alias(c) for c in CUES), keep(F.col("a.confidence")).alias("confidence"), keep(F.left(F.col("a.rationale"), F.lit(400))).alias("rationale"),
        F.when(bad, F.concat(F.lit("invalid: "), F.array_join(wrong, ", "))).alias("error"),
    )


def answer_schema() -> dict:
    """What a client has to hold an answer to, as JSON schema: the properties in the order in which they are to be thought of, cues before the verdict."""
    one_of = lambda k: {"type": "string", "enum": list(DOMAINS[k])}
    names = [c.removeprefix("cue_") for c in CUES]
    cues = {"type": "object", "properties": {n: {"type": "boolean"} for n in names}, "required": names}
    properties = {
        "language": one_of("language"), "literal_sentiment": one_of("literal_sentiment"), "cues": cues, "sarcastic": {"type": "boolean"}, "intended_sentiment": one_of("intended_sentiment"),
        "confidence": {"type": "number", "minimum": 0, "maximum": 1}, "rationale": {"type": "string", "maxLength": 300},
    }
    return {"type": "object", "properties": properties, "required": list(properties)}


def fault_of(answer: str, schema: dict | None = None) -> str | None:
    """Why an answer's outermost object doesn't fit the schema (its flat kinds, enums and bounds); None if it does."""
    schema = schema or answer_schema()
    found = re.search(r"\{.*\}", re.sub(r"<think>.*?</think>", "", answer or "", flags=re.S), re.S)
    try:
        got = json.loads(found[0]) if found else None
    except ValueError as e:
        return f"no JSON: {e}"
    if not isinstance(got, dict):
        return "no JSON object"
    kinds = {"string": str, "boolean": bool, "number": (int, float), "object": dict}
    for name, rule in schema["properties"].items():
        x = got.get(name)
        if x is None:
            if name in schema["required"] and name != "rationale":
                return f"missing {name}"
        elif not isinstance(x, kinds[rule["type"]]) or rule["type"] == "number" and isinstance(x, bool):
            return f"{name} is no {rule['type']}"
        elif "enum" in rule and x not in rule["enum"] or "minimum" in rule and not rule["minimum"] <= x <= rule["maximum"]:
            return f"{name} is {x}"
        elif rule["type"] == "object" and not all(isinstance(x.get(k), bool) for k in rule["required"]):
            return f"{name} lacks {next(k for k in rule['required'] if not isinstance(x.get(k), bool))}"
    return None


class Ask(Protocol):
    """A client's call: the schema constrains what is decoded, where the model server can do that."""

    def __call__(self, prompt: str, *, schema: dict, temperature: float) -> str: ...


#: Answers that leave a task at once.
ASKED = 200


def annotate(prompts: DataFrame, client: Callable[[], Ask], attempts: int = 3, warm: float = 0.2, pause: Callable[[int], float] = lambda n: min(30.0, 2.0**n)) -> DataFrame:
    """item_id, answer, attempts, duration_ms, call_error, from an injected client that is made once a task.

    A call that raises is tried again after a pause, an answer that doesn't fit the schema at once; the last attempt is a little warmer, as
    the same answer would come back otherwise. What fails to the end becomes an error row, never a lost task.
    """
    if attempts < 1:
        raise ValueError("at least one attempt")

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask, schema = client(), answer_schema()

        def tried(p: str) -> tuple[str | None, int, int, str | None]:
            began, last = time.monotonic(), None
            spent = lambda: int((time.monotonic() - began) * 1000)
            for n in range(1, attempts + 1):
                try:
                    got = ask(p, schema=schema, temperature=warm if n == attempts > 1 else 0.0)
                except Exception as e:  # noqa: BLE001
                    last = str(e)
                    if n < attempts:
                        time.sleep(pause(n))
                    continue
                last = fault_of(got, schema)
                if last is None:
                    return got, n, spent(), None
            return None, attempts, spent(), f"failed after {attempts} attempts: {last}"[:2000]

        # a prompt is text only while it is asked, answers leave a few at a time: what is held is the batch as it came
        for b in batches:
            for i in range(0, b.num_rows, ASKED):
                part = b.slice(i, ASKED)
                rows = [(item.as_py(), *tried(prompt.as_py())) for item, prompt in zip(part["item_id"], part["prompt"], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string()), strict=True)], ["item_id", "answer", "attempts", "duration_ms", "call_error"])

    return prompts.select(F.col("item_id").cast("string"), "prompt").mapInArrow(call, "item_id string, answer string, attempts int, duration_ms long, call_error string")


def votes_and_failures(asked: DataFrame, model: str, version: str, role: str) -> tuple[DataFrame, DataFrame]:
    """Of annotate() the rows to store: votes of one rater in one role, and failures with the reason."""
    got = parse_answers(asked.filter("answer IS NOT NULL").drop("attempts", "call_error"))
    who = {"model_key": F.lit(model), "prompt_version": F.lit(version), "role": F.lit(role)}
    bad = got.filter("error IS NOT NULL").select("item_id", "error").unionByName(asked.filter("answer IS NULL").select("item_id", F.col("call_error").alias("error")))
    return got.filter("error IS NULL").drop("error").withColumns(who), bad.withColumns(who)


def adjudicator_prompts(prompts: DataFrame, ratings: DataFrame, lineup: list[str], version: str) -> DataFrame:
    """The prompts of items that go to the adjudicator, with the raters' votes in the lineup's order below them."""
    at = F.array_position(F.array(*(F.lit(m) for m in lineup)), F.col("model_key"))
    verdict = F.when(F.col("sarcastic") == 1, "sarcastic").when(F.col("sarcastic") == 0, "not sarcastic").otherwise("no verdict")
    line = F.concat(F.lit("- "), "model_key", F.lit(": "), verdict, F.lit(", "), F.concat_ws(", ", "language", "literal_sentiment", "intended_sentiment"), F.coalesce(F.concat(F.lit(" ("), "rationale", F.lit(")")), F.lit("")))
    mine = ratings.filter((F.col("role") == "annotator") & (F.col("prompt_version") == version) & F.col("model_key").isin(*lineup))
    said = mine.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct(at.alias("at"), line.alias("line")))).alias("votes"))  # a vote a rater
    block = F.concat(F.lit("\n\n=== VOTES ===\n"), F.array_join(F.transform("votes", lambda x: x["line"]), "\n"))
    return prompts.join(said, "item_id", "left").select("item_id", F.concat("prompt", F.coalesce(block, F.lit(""))).alias("prompt"))


def prompt(context: Column, record_type: Column, text: Column) -> Column:
    """X27."""
    return F.concat(context, F.lit("\n\n=== TARGET ("), record_type, F.lit(") ===\n"), text)


def content_hash(*parts: str) -> str:
    """X23."""
    import hashlib

    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def version_states(registered: DataFrame, prompts: DataFrame) -> DataFrame:
    """prompts(prompt_version, prompt, schema) against registered(prompt_version, content_hash): `new`, `known`, or `changed` under
    a name that is taken. Only new ones may be added, and nothing may run under a changed one."""
    now = prompts.select("prompt_version", F.sha2(F.concat_ws("\n", "prompt", "schema"), 256).alias("content_hash"))
    old = registered.select(F.col("prompt_version").alias("_v"), F.col("content_hash").alias("_h"))
    state = F.when(F.col("_v").isNull(), "new").when(F.col("_h") == F.col("content_hash"), "known").otherwise("changed")
    return now.join(old, now["prompt_version"] == old["_v"], "left").select("prompt_version", "content_hash", state.alias("state"))


def check_version(stored: DataFrame, version: str, digest: str) -> None:
    """Raises when a registered version's content has changed."""
    row = stored.filter(F.col("prompt_version") == version).select("content_hash").first()
    if row and row[0] != digest:
        raise RuntimeError(f"the prompt of version {version} has changed")


def evaluation_queue(selected: DataFrame, done: DataFrame, failed: DataFrame, corpus: DataFrame, snapshots: DataFrame, version: str) -> DataFrame:
    """Each selected item's state, first rule that holds."""
    flag = lambda df, name: df.select("item_id", F.lit(True).alias(name)).distinct()
    out = selected.select("item_id").join(flag(done, "_d"), "item_id", "left").join(flag(failed, "_f"), "item_id", "left").join(flag(corpus, "_c"), "item_id", "left").join(flag(snapshots.filter(F.col("prompt_version") == version), "_s"), "item_id", "left")
    state = F.when(F.col("_d"), "already_done").when(F.col("_f"), "skipped_failed").when(F.col("_c").isNull(), "no_record").when(F.col("_s").isNull(), "no_context").otherwise("pending")
    return out.select("item_id", state.alias("state"))
