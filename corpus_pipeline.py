"""A training corpus from `documents`: stages that each call one operator of codesieve.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's docs. All stages but the last return the columns of documents. Rows that an operator cannot
judge (null id) stay, as each operator's docstring says.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.llm import bpe_tree, line_dedup, ngram_join, ngram_quality, temperature_mix
from codesieve.llm.common import stored, table, whole
from codesieve.llm.queries import tokenizer_path


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = {"doc_id", "text", "lang", "source", "n_chars"}


def keeps_columns(stage: Stage) -> Stage:
    """The stage, with columns beyond those of documents out of the way of the operators' own names."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        aside = {c: f"_extra{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        out = stage(spark, docs.withColumnsRenamed(aside), sf_dir)
        return out.withColumnsRenamed({v: k for k, v in aside.items()})

    return run_stage


@keeps_columns
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return ngram_quality.keep_good(docs)


@keeps_columns
def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document has; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs)
    lost = F.col("n_dropped") > 0
    kept = kept.withColumn("text", F.when(lost, F.col("kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(lost, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


@keeps_columns
def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies (five words, similarity 0.8 or more) the document with the smallest id.

    Rows that repeat an id that stays all stay; so do rows without id.
    """
    classes = ngram_join.jaccard_classes(docs, k=5, percent=80)
    gone = classes.where("doc_id <> component_id").select("doc_id").distinct()
    return ngram_join.without(docs, gone).select(*docs.columns)


@keeps_columns
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to twice, by temperature weights."""
    order, _ = temperature_mix.mix(docs, max_repeats=2.0)
    taken = order.groupBy(F.col("doc_id").alias("_id"), F.col("_text_key").alias("_t"), F.col("source").alias("_s"))
    taken = taken.agg(F.countDistinct("epoch").cast("int").alias("_times"))
    rows = docs.withColumn("_key", F.xxhash64(whole(F.col("text"))))
    same = rows["doc_id"].eqNullSafe(F.col("_id")) & (rows["_key"] == F.col("_t")) & rows["source"].eqNullSafe(F.col("_s"))
    return rows.join(taken, same).withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times"))).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and ids of every taken copy."""
    rows = bpe_tree.encode(docs.select("doc_id", "source", "text"), tokenizer_path()).drop("text")
    return rows.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", without_repeated_lines),
    ("ngram_join", one_of_near_copies),
    ("temperature_mix", mixed_sources),
    ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows but the last's are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# The language model of the first stage has no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL: str | None = None
