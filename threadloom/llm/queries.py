"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import language_id

    return language_id(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .superkmer import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents"))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ppm import lm_scores

    return lm_scores(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .cube import mixed_sizes

    return mixed_sizes(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_wavelet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .wavelet import token_files

    return token_files(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sp_bpe import sentencepiece_digest

    return sentencepiece_digest(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .additive import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic import run_digest

    return run_digest(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .divergence import source_divergence

    return source_divergence(table(spark, sf_dir, "documents"))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urlfilter import url_verdicts

    return url_verdicts(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_language_id, op2_substring_dedup, op3_lm_scores, op4_mixing, op5_quality_rules, op6_toxicity, op7_wavelet_files, op8_jaccard_join, op9_sentencepiece, op10_nearest)
    found += (op11_periodic_runs, op12_source_divergence, op13_url_filters)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    from . import divergence, jaccard, quality, superkmer, urlfilter

    found = {"op2_substring_dedup": superkmer.SQL, "op5_quality_rules": quality.SQL, "op8_jaccard_join": jaccard.SQL}
    return found | {"op12_source_divergence": divergence.SQL, "op13_url_filters": urlfilter.SQL}
