"""Corpus pipeline: documents in, a mixed training set out.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor
kept; its result is written as Parquet and read again for the next one.  All
stages but the last return the columns of ``documents`` (``n_chars`` follows the
text); the last returns one row per document with its copies.

1. quality rules        rejected documents go
2. line dedup           repeated lines go, except in their first document
3. n-gram Jaccard join  one document of each class of near duplicates stays
4. decontamination      documents that hold a benchmark window go
5. mixing               copies per document that meet the sources' target words
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import decontam, lines, mixing, ngram_join, quality_rules
from riskspark.llm.common import materialize, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_documents(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(docs, counts=False)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.char_length(F.coalesce(F.col("text"), F.lit(""))).cast(docs.schema["n_chars"].dataType))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_per_class(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: the first stage is a fitted classifier, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
