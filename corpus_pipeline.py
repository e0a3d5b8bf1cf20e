"""Documents to packed training sequences: quality, toxicity, near copies, benchmark leaks, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salespect.functions.staging import staged
from salespect.llm import decontaminate, jaccard_join, packing, quality, toxicity
from salespect.llm.queries import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.train(docs))


def keep_harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(toxicity.training_rows(docs, labels)))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_per_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack(docs, tokenizer_path(), end_id=1, digests=True))


STAGES = [
    ("quality", keep_quality),
    ("toxicity", keep_harmless),
    ("near_copies", one_per_group),
    ("decontamination", without_benchmark),
    ("packing", pack_documents),
]

# Trained models and similarity joins cannot be expressed in SQL; tests/llm tests near copies, leaks and the whole run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
