"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import ann, decontaminate, hmm_lm, langid, line_dedup, mixing, ngram_join, pii, sentence_spans, suffix_dedup
from tallyforge.llm.kernels import narrow_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    narrow_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score(table(spark, sf_dir, "documents"))


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.digest(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_to_targets(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_decontaminate": op1_decontaminate, "op2_ngram_join": op2_ngram_join, "op3_pii": op3_pii, "op4_lm_score": op4_lm_score, "op5_sentence_spans": op5_sentence_spans, "op6_suffix_dedup": op6_suffix_dedup, "op7_line_dedup": op7_line_dedup, "op8_language_id": op8_language_id, "op9_nearest": op9_nearest, "op10_mixing": op10_mixing}


def oracle_sql() -> dict[str, str]:
    return {"op2_ngram_join": ngram_join.ORACLE, "op5_sentence_spans": sentence_spans.ORACLE, "op10_mixing": mixing.ORACLE}
