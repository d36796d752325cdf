"""The operators on the given tables: name to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from innsight.llm import (
    collocations, common, counting, decontamination, jaccard, lines, personal, quality, ranking, secrets, sharding, simhash,
    tokens, warc,
)

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 16


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(name: str, *columns: str):
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        common.ship(spark)
        return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)

    return read


_texts = _table("documents", "doc_id", "text")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(
        _texts(spark, sf_dir), _table("benchmark", "item_id", "text")(spark, sf_dir)
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_texts(spark, sf_dir))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(_table("documents", "doc_id", "source", "text")(spark, sf_dir))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_texts(spark, sf_dir))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir)
    return quality.score(docs, bands=quality.fit(docs, _table("labels", "doc_id", "quality")(spark, sf_dir)))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_texts(spark, sf_dir), [1.0] * SHARDS)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{common.shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    pages = _table("pages", "page_id", "url", "html")(spark, sf_dir)
    return warc.round_trip(pages, folder).drop("url")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find(_texts(spark, sf_dir))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(_texts(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.count_tokens(_texts(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_texts(spark, sf_dir))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table("documents", "lang", "text")(spark, sf_dir))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(_texts(spark, sf_dir), _table("benchmark", "item_id", "text")(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_simhash": op2_simhash,
        "op3_line_dedup": op3_line_dedup,
        "op4_secret_scan": op4_secret_scan,
        "op5_quality_rules": op5_quality_rules,
        "op6_sharding": op6_sharding,
        "op7_warc": op7_warc,
        "op8_personal_data": op8_personal_data,
        "op9_bpe": op9_bpe,
        "op10_token_counts": op10_token_counts,
        "op11_ngram_jaccard": op11_ngram_jaccard,
        "op12_collocations": op12_collocations,
        "op13_ranked_search": op13_ranked_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_dedup": lines.REPORT_SQL,
        "op7_warc": warc.ROUND_TRIP_SQL,
        "op11_ngram_jaccard": jaccard.JOIN_SQL,
        "op12_collocations": collocations.COLLOCATIONS_SQL,
        "op13_ranked_search": ranking.RANK_SQL,
    }
