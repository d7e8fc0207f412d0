"""Corpus pipeline: toxicity, quality rules, line dedup, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept and returns the columns of
documents, the last one packed pieces. ``run`` writes each stage's rows to the shared folder and rereads them, so
a lost executor repeats part of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import line_dedup, packing, quality_rules, simhash, toxicity
from broadsheet.llm.common import free_name, table, tokenizer_path
from broadsheet.session import cut

TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the limit go."""
    found, name = toxicity.toxic_column(docs, table(spark, sf_dir, "labels")), free_name(docs, "_toxicity")
    return docs.withColumn(name, found).filter(F.col(f"{name}.score") < TOXIC_FROM).drop(name)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or an admitted cutoff rejects go."""
    return quality_rules.judge(docs, table(spark, sf_dir, "labels")).filter("_kept").drop("_quality", "_kept")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; n_chars follows the text."""
    kept = line_dedup.remove_repeats(docs).withColumn("text", F.col("_lines.text"))
    return kept.withColumn("n_chars", F.when(F.col("_lines.n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).drop("_lines")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document with the smallest id stays."""
    return simhash.keep_first(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into windows."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: The toxicity field is a fitted model, which SQL cannot express; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
