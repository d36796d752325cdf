"""A training-data pipeline over ``documents``: each stage works on all rows that the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from innsight.llm import common, decontamination, lines, quality, simhash, tokens
from innsight.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the compression bands, fitted on all that ``labels`` call good, reject go.

    Null and empty texts have no words and go; rows that repeat are judged alike and stay or go together.
    """
    common.ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.keep(docs, bands=quality.fit(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sources share stay only where they come first; a document left without words goes."""
    return lines.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints at most two bits apart stays, that of least id.

    Texts without words have one fingerprint, so one of them stays. Of rows that repeat one stays; null ids come last.
    """
    common.ship(spark)
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or one within the edit limit, go.

    Null and empty texts hold none and stay, as does everything where the benchmark is empty. Each row is judged by itself.
    """
    common.ship(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontamination.keep(docs, benchmark)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, as count and digest, and the digest of the text decoded from them.

    One row per row; a null text counts as empty.
    """
    common.ship(spark)
    return tokens.round_trip(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("byte-pair encoding", encode),
]

#: The bands of Zstandard ratios and the encoding can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what a stage keeps is written below the shared folder and read again."""
    folder = f"{common.shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
