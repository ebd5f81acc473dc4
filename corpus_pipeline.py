"""A pipeline from documents to packed training sequences.

Each stage takes the documents its predecessor kept; all but the last return the
columns of ``documents``. Stages are written as Parquet and read again in between.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import mixing, packing, quality, secrets, simhash
from tallyloom.llm.texts import importable
from tallyloom.sources.tables import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the adaptive fences of their language and source let pass."""
    importable(spark)
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash near duplicates: 3-word shingles, 2 bits."""
    importable(spark)
    return simhash.one_per_component(docs, words=3, max_bits=2)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret replaced by a mask; all documents stay."""
    importable(spark)
    return secrets.redact(docs).withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by rates that meet the wanted tokens per domain: all clean text, half of the low, nothing toxic.

    No document is taken twice, so the targets are such that rates up to 1 can meet them.
    """
    importable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.draw(docs, mixing.mix(docs, labels, {"clean": 1.0, "low": 0.5, "toxic": 0.0}, most=1.0))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 1024 tokens."""
    importable(spark)
    return packing.pack(docs, capacity=1024, tokenizer="byte_bpe_50k.json", end_id=2)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret scans", secret_scan),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: Ball hashing, the fitted rates and the tokenizer have no counterpart in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
