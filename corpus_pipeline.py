"""A corpus pipeline of five stages: language ID, line dedup, near-duplicate join, decontamination, mixing.

Every stage is written as Parquet and read again as the next one's documents, so a lost executor costs a task and a
lost stage costs that stage.  Each function takes ``(spark, docs, sf_dir)``; all but the last return the columns of
``documents``, in the order and with the extra columns that docs has.

Defined cases, in every stage: an empty table gives an empty one; null texts count as empty; a row without a doc_id is
judged by its own text alone: it goes if it has no letter, and is otherwise in no line dedup, join or decontamination;
columns beside those of ``documents`` are carried along, whatever their names, but a column named size, source_size, target
or taken gives way to the last stage's own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm import decontaminate, langid, line_dedup, mixing, ngram_join
from tallyforge.llm.kernels import narrow_batches
from tallyforge.plans.scratch import staged

#: What the tests count as short; no rule here depends on it.
LONG = 200


def _without(docs: DataFrame, ids: DataFrame, tag: str) -> DataFrame:
    return docs.join(staged(ids.select("doc_id").distinct(), tag), "doc_id", "left_anti").select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are in no language: those without a letter, and those that the network, taught gibberish beside the
    labelled languages, gives to none (``langid.in_no_language``), a text in another script included.  Every row is judged by
    its own whole text; the shorter it is, the surer the network must be, and up to 64 bytes none goes.
    Without a labelled row nothing is learned, and letters alone decide."""
    narrow_batches(spark)
    sieve = langid.learn_sieve(docs)
    docs = docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return docs.where(~langid.in_no_language(F.col("text"), sieve)) if sieve else docs


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out repeated lines; a document of which no word is left goes.  n_chars follows the text."""
    narrow_batches(spark)
    out = line_dedup.deduplicate(docs)
    return out.where(F.regexp_like("text", F.lit(mixing.WORD))).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component of J >= 0.75; of rows that share an id, the first by
    text, source and language."""
    narrow_batches(spark)
    out = _without(docs, ngram_join.components(docs).where("component_id <> doc_id"), "dropped")
    twins = staged(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "twins")
    if not twins.take(1):
        return out
    # Rows that share an id are few copies of it, never a growing group.
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text", "source", "lang", "n_chars"))
    own = out.join(twins, "doc_id", "left_semi").select(F.struct(*out.columns).alias("row"), "doc_id", "text", "source", "lang", "n_chars")
    own = own.select("row", first.alias("first")).where("first = 1").select("row.*")
    return out.join(twins, "doc_id", "left_anti").select(docs.columns).union(own.select(docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    narrow_batches(spark)
    return _without(docs, decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "contaminated")


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds size, source_size, target and taken; documents that the mix doesn't take go."""
    return mixing.mix_to_targets(docs, keep=docs.columns).where("taken > 0")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_deduplication),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_to_targets),
]

#: The language model of the first stage is trained, which SQL can't express; tests/llm/test_pipeline.py has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
