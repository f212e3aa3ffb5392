"""A corpus from raw documents to packed sequences: five stages, each written as a table and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geocadence.llm.cuckoo import without_duplicates
from geocadence.llm.jaccard import one_of_each
from geocadence.llm.mixing import mixed_documents
from geocadence.llm.packing import packed
from geocadence.llm.queries import held_out
from geocadence.llm.toxicity import trained, without_toxic
from geocadence.session import scratch

ORACLE_SQL = None  # spelling models, tokens and the seeded deal of blocks are not SQL; tests/llm/test_pipeline.py has a brute-force twin


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score 0.7 or more; learns from labelled documents whose crc32 of doc_id is not 1 modulo 3."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(3, 1))
    return without_toxic(docs, trained(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal up to white space the smallest doc_id stays."""
    return without_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays, the smallest doc_id."""
    return one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by their target weights: documents leave, are cut, or are there up to three times."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their places in sequences."""
    return packed(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_duplicates", near_duplicates), ("source_mixing", source_mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
