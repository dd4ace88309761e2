"""State transitions on immutable tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..scratch import held
from .review import lowest, seeded


def upsert(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the delta replace those with their keys."""
    return base.join(delta.select(*keys), keys, "left_anti").select(*base.columns).unionByName(delta, allowMissingColumns=True)


def insert_new(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """The base with those rows of the delta whose keys it lacks; a key given twice counts once, its least row."""
    once = Window.partitionBy(*keys).orderBy(*(F.col(c) for c in delta.columns))
    fresh = delta.join(base.select(*keys), keys, "left_anti").withColumn("_n", F.row_number().over(once)).filter("_n = 1").drop("_n")
    return base.unionByName(fresh.select(*delta.columns), allowMissingColumns=True)


def completed(queue: DataFrame, reviews: DataFrame) -> DataFrame:
    """A queue item is completed once it has a review."""
    done = reviews.select("item_id", F.lit(1).alias("_d")).distinct()
    return queue.join(done, "item_id", "left").withColumn("completed", F.greatest("completed", F.coalesce("_d", F.lit(0)))).select(*queue.columns)


def migrated(rows: DataFrame, schema: StructType) -> DataFrame:
    """Rows of an older shape in the schema's columns and kinds; what they lack is null, what the schema lacks goes."""
    return rows.select(*((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def failure(rows: DataFrame, error: str = "error") -> DataFrame:
    """M07."""
    return rows.withColumn(error, F.left(F.col(error), F.lit(2000)))


def cleared(failures: DataFrame, model: str, version: str, role: str) -> DataFrame:
    """M06."""
    return failures.filter(~((F.col("model_key") == model) & (F.col("prompt_version") == version) & (F.col("role") == role)))


def retag(records: DataFrame) -> DataFrame:
    """A calendar walk's tag (keyword_oversampled with a date for keyword) is natural."""
    wrong = F.coalesce((F.col("sampling_strategy") == "keyword_oversampled") & F.col("matched_query_or_keyword").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))
    return records.withColumns({"retagged": wrong, "sampling_strategy": F.when(wrong, "natural").otherwise(F.col("sampling_strategy")), "matched_query_or_keyword": F.when(~wrong, F.col("matched_query_or_keyword"))})


def scrub(records: DataFrame) -> DataFrame:
    """P17."""
    return records.drop("author")


def extension_sample(candidates: DataFrame, taken: DataFrame, quotas: dict[str, int], seed: int = 13) -> DataFrame:
    """For each month so many new items by the hash of seed and id. `candidates` has item_id and month."""
    fresh = held(candidates.filter(F.col("month").isin(*quotas)).join(taken.select("item_id"), "item_id", "left_anti"))
    table = fresh.groupBy(F.col("month").alias("of")).agg(F.count("*").alias("n")).withColumn("quota", quota_of(quotas))
    return lowest(fresh, "month", seeded(seed), "item_id", held(table))


def quota_of(quotas: dict[str, int]) -> Column:
    return F.coalesce(*(F.when(F.col("of") == m, F.lit(q).cast("long")) for m, q in quotas.items()), F.lit(0).cast("long"))


def fork(ratings: DataFrame, aggregates: DataFrame, queue: DataFrame, extension: DataFrame, lineup: list[str], version: str) -> dict[str, DataFrame]:
    """A copy for another lineup: its votes under one version stay, aggregates start empty, gold stays queued, base items come before the extension."""
    base = aggregates.filter((F.col("prompt_version") == version) & F.col("sarcastic_final").isNotNull()).select("item_id", F.lit(2).alias("priority"))
    more = extension.join(base, "item_id", "left_anti").select("item_id", F.lit(1).alias("priority"))
    kept = ratings.filter((F.col("prompt_version") == version) & (F.col("role") == "annotator") & F.col("model_key").isin(*lineup))
    return {"ratings": kept, "aggregates": aggregates.limit(0), "queue": queue.filter("reason = 'gold'"), "target_priority": base.unionByName(more)}


def shortfall(drawn: DataFrame, quotas: dict[str, int]) -> DataFrame:
    """Month, wanted, found, short for every month asked for."""
    wanted = F.create_map(*(F.lit(x) for kv in sorted(quotas.items()) for x in kv))
    months = drawn.sparkSession.range(1).select(F.explode(wanted).alias("month", "wanted"))  # as many rows as months asked for
    found = drawn.groupBy("month").agg(F.count("*").alias("found"))
    return F.broadcast(months).join(found, "month", "left").select("month", "wanted", F.coalesce("found", F.lit(0)).alias("found"), (F.col("wanted") - F.coalesce("found", F.lit(0))).alias("short"))


def parse_extend(text: str) -> dict[str, int]:
    """`2026-06=3,2026-10=2` -> quotas; a number that is not above 0, a month given twice or anything else raises."""
    import re

    out: dict[str, int] = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        m = re.fullmatch(r"(\d{4}-(?:0[1-9]|1[0-2]))[=:](\d+)", part)
        if not m or not int(m[2]):
            raise ValueError(f"not a month and a number above 0: {part!r}")
        if m[1] in out:
            raise ValueError(f"{m[1]} is given twice")
        out[m[1]] = int(m[2])
    if not out:
        raise ValueError("no month given")
    return out


def run_counters(before: DataFrame, offered: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that a run saw, by kind: stored, duplicates within the run, and those that were there already."""
    known = before.select(*keys).distinct().withColumn("_known", F.lit(True))
    rows = offered.join(known, keys, "left").groupBy(*keys, "record_type").agg(F.count("*").alias("_n"), F.max("_known").alias("_known"))
    there = F.coalesce("_known", F.lit(False))
    return rows.groupBy("record_type").agg(
        F.sum("_n").alias("seen"), F.count_if(~there).alias("stored"), F.sum(F.when(there, 0).otherwise(F.col("_n") - 1)).alias("repeated"), F.sum(F.when(there, F.col("_n")).otherwise(0)).alias("known")
    )
