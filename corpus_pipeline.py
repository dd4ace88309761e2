"""The corpus pipeline: five stages, each one of the training-data operators, each written as Parquet and reread by the next.

A stage takes (spark, docs, sf_dir) and works on every row its predecessor kept; all but the last return the columns of documents.

Cases, in every stage: rows with a null doc_id go at the first; null and empty texts are documents without words (not toxic, linked
with nothing, nothing to take out of them, size 0); repeated rows become one in the second stage; a doc_id with several texts keeps
those that the stage keeps, each judged for itself; further columns are dropped, whatever their names; nulls in lang, source and
n_chars stay; an empty table passes through as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.llm.common import shared_dir, table, written
from threadloom.llm.cube import mix
from threadloom.llm.jaccard import one_of_each
from threadloom.llm.queries import tokenizer_file
from threadloom.llm.sp_bpe import digest
from threadloom.llm.superkmer import without_repeats
from threadloom.llm.toxicity import without_toxic
from threadloom.shipping import ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go. Labels are read from the tables; only training rows teach."""
    ship(spark)
    return without_toxic(docs.select(*COLUMNS).filter("doc_id IS NOT NULL"), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join stays, the one with the least doc_id."""
    ship(spark)
    return one_of_each(docs.select(*COLUMNS))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of windows that a document with a smaller doc_id has too go; documents that lose every word go."""
    ship(spark)
    return without_repeats(docs.select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as many times as it is taken, so one that is not taken goes."""
    ship(spark)
    docs = docs.select(*COLUMNS)
    keys = ["doc_id", "_key", "_source"]
    taken = mix(docs).groupBy("doc_id", F.col("text_key").alias("_key"), F.struct("source").alias("_source")).agg(F.sum("copies").alias("_sum"))
    # rows of one doc_id, text and source are alike to the mix: what it takes of them is dealt evenly, the first by their other columns first
    same = Window.partitionBy(*keys)
    rows = docs.withColumn("_key", F.xxhash64("text")).withColumn("_source", F.struct("source"))
    rows = rows.withColumn("_nth", F.row_number().over(same.orderBy("lang", "n_chars"))).withColumn("_rows", F.count("*").over(same))
    share = F.floor(F.col("_sum") / F.col("_rows")) + (F.col("_nth") <= F.col("_sum") % F.col("_rows")).cast("int")
    dealt = rows.join(taken, keys).withColumn("_copies", share.cast("int")).filter("_copies > 0")
    return dealt.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids by the SentencePiece agenda, and their round trip: doc_id, n_tokens, ids_sha256, decoded_sha256, agrees."""
    ship(spark)
    return digest(docs.select("doc_id", "text"), tokenizer_file("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("mixing sources", mixing),
    ("SentencePiece encoding", encoding),
]

#: The trained classifier and the balanced draw are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are a table in the shared folder."""
    docs, folder = table(spark, sf_dir, "documents"), shared_dir(spark)
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), folder, f"stage{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
