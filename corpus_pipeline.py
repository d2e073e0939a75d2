"""From documents to packed training sequences, one operator per stage.

Each stage takes all its predecessor kept, is written as Parquet below the
shared folder, and the next one reads that.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepanel.llm import exact_dedup, packing, quality, simhash, toxicity
from tidepanel.llm.common import free_name
from tidepanel.session import scratch_path

#: Of the stages' contracts: scores from which a document counts as label 1.
TOXIC_FROM = 0.3
GOOD_FROM = 0.5
END_OF_TEXT = 0


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity score is below the threshold."""
    score = free_name(docs, "toxicity")
    model = toxicity.fit_toxicity(docs, _labels(spark, sf_dir))
    return toxicity.with_toxicity(docs, model, score).filter(F.col(score) < TOXIC_FROM).drop(score)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose quality score reaches the threshold."""
    score = free_name(docs, "quality")
    model = quality.fit_quality(docs, _labels(spark, sf_dir))
    return quality.with_quality(docs, model, score).filter(F.col(score) >= GOOD_FROM).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked texts the document with the smallest id."""
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, END_OF_TEXT
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("packing", pack),
]

#: Trained classifiers and best fit have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`; the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
