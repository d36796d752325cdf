"""Sharding by rendezvous hashing.

Each shard draws a score from the hash of (key, shard) and its weight; the key
goes to the shard with the least score. A new shard takes keys only into itself,
and a key's shard depends on nothing but the key and the weights.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Groups that a shard's rows are numbered in. With 16 shards the table of group
#: sizes has at most 65,536 rows, whatever the size of the data.
SLOT_GROUPS = 4096


def _score(key: Column, shard: int, weight: float) -> Column:
    # Upper 52 bits of the hash as a number in (0, 1): an exponential variable of rate `weight`.
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(shard), key), 12)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52))) / F.lit(float(weight))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard of a key. A null key is a key like any other."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    scores = [F.struct(_score(key, n, w).alias("score"), F.lit(n).alias("shard")) for n, w in enumerate(weights)]
    return F.array_min(F.array(*scores))["shard"] if len(scores) > 1 else F.lit(0)


def grown_shard(key: Column, shard: Column, weights: Sequence[float], added: float) -> Column:
    """The shard once one of weight ``added`` is appended."""
    grown = shard_of(key, [*weights, added])
    return F.when(grown == len(weights), F.lit(len(weights))).otherwise(shard)


def assign(docs: DataFrame, weights: Sequence[float], added: float = 1.0) -> DataFrame:
    """Shard and place in the shard of every row (doc_id, text; other columns are ignored).

    ``slot`` counts each shard's rows from 0 without a gap. Rows are numbered in
    hashed groups of a shard and shifted by the rows of the groups before, so that
    no task holds a whole shard. The hash is of id, checksum and size: rows that
    share an id spread unless their texts are equal too, and such rows get
    different slots in any order. A null text has no bytes.
    """
    data = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    rows = (
        docs.select(
            "doc_id",
            (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
            F.crc32(data).alias("text_crc32"),
        )
        .withColumn("shard", shard_of(F.col("doc_id"), weights))
        .withColumn("slot_group", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(SLOT_GROUPS)))
    )
    before = F.expr(
        "sum(n) over (partition by shard order by slot_group rows between unbounded preceding and 1 preceding)"
    )
    shifts = (
        rows.groupBy("shard", "slot_group")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "slot_group", F.coalesce(before, F.lit(0)).alias("shift"))
    )
    place = F.expr(
        "row_number() over (partition by shard, slot_group order by doc_id, text_crc32, size)"
    )
    return (
        rows.withColumn("place", place)
        .join(shifts, ["shard", "slot_group"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("shift") + F.col("place") - 1).cast("long").alias("slot"),
            grown_shard(F.col("doc_id"), F.col("shard"), weights, added).cast("int").alias("grown_shard"),
        )
    )
