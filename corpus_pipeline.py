"""Corpus pipeline: STAGES over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tickweave.llm import language_id, line_dedup, ngram_join, packing
from tickweave.session import scratch_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no language that is likelier than not, go."""
    return language_id.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more in three or more documents stay in the last one only."""
    return line_dedup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word n-grams, Jaccard 0.8) the smallest doc_id stays."""
    return ngram_join.keep_one_of_each(docs, words=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts that are left, as token windows of 2048; a row for each piece."""
    return packing.pack(docs)


#: (name, function of (spark, docs, sf_dir)); all but the last return the columns of documents.
STAGES = [("language_id", identify_language), ("line_dedup", dedup_lines), ("ngram_join", drop_near_copies), ("packing", pack)]

#: No SQL states the trained classifier or the packing plan; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = scratch_dir(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
