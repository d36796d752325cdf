"""Joins and rankings that hold when one key owns a large part of all rows.

A key is *hot* when it has more rows than one task should take (``hot_rows``).
At most ``rows / hot_rows`` keys can be hot, so the list of hot keys is always
small enough to broadcast, whatever the data: 10^11 rows at the default give at
most 20,000 short rows. A caller who lowers ``hot_rows`` takes that bound with it:
at 1 every repeated key is on the list. Where no key is hot, that list is empty and adaptive
execution drops the extra branch at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 5_000_000
_SALT = "_salt"
_PIECES = "_pieces"
_ROWS = "_rows"


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows; reads the key columns only."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS))
    return counted.filter(F.col(_ROWS) > hot_rows).select(*keys)


def frequent_keys(
    df: DataFrame, key: str, hot_rows: int, rows: str, most: int = 10_000, tracked: int = 65_536, groups: int = 64
) -> DataFrame:
    """Keys with about ``hot_rows`` rows or more and that number, by frequent-items sketches.

    Unlike :func:`hot_keys` it shuffles sketches alone, so that keys of any number are
    counted without a row each. A key is missed only where it has less than about a
    share of ``1 / tracked`` of the rows a group of tasks reads. Null is no key.
    """
    sketched = (
        df.filter(F.col(key).isNotNull())
        .groupBy((F.spark_partition_id() % groups).alias("_group"))
        .agg(F.expr(f"approx_top_k({key}, {most}, {tracked})").alias("_top"))
    )
    reported = sketched.select(F.explode("_top").alias("_t")).groupBy(F.col("_t.item").alias(key))
    return reported.agg(F.sum("_t.count").alias(rows)).filter(F.col(rows) > hot_rows)


def spread_join(
    fact: DataFrame,
    per_key: DataFrame,
    key: str,
    rows: str,
    spread_by: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner join of ``fact`` with a table of one row per ``key``.

    ``per_key[rows]`` is the number of fact rows of the key. Rows of a hot key
    are spread over ``ceil(rows / hot_rows)`` pieces by a hash of ``spread_by``,
    and the key's single row is repeated once per piece; other keys join as
    they are. Spark still broadcasts ``per_key`` when it turns out small.
    """
    pieces = F.ceil(F.col(rows) / F.lit(hot_rows)).cast("int")
    hot = per_key.filter(F.col(rows) > hot_rows).select(key, pieces.alias(_PIECES))
    piece = F.pmod(F.xxhash64(*spread_by), F.col(_PIECES)).cast("int")
    salted = (
        fact.join(F.broadcast(hot), key, "left")
        .withColumn(_SALT, F.when(F.col(_PIECES).isNotNull(), piece).otherwise(0))
        .drop(_PIECES)
    )
    repeated = per_key.withColumn(_SALT, F.explode(F.sequence(F.lit(0), pieces - 1)))
    return salted.join(repeated, [key, _SALT]).drop(_SALT)


def top_n(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
    hot: DataFrame | None = None,
    pieces: int = 64,
    ties: bool = False,
) -> DataFrame:
    """First ``n`` rows of each key under a total order, with their rank.

    Spark cuts every map task to ``n`` rows per key before the shuffle
    (``WindowGroupLimit``), so a key reaches its final task with at most
    ``n`` rows per map task. Keys listed in ``hot`` (from :func:`hot_keys`) are
    ranked in two steps, first within ``pieces`` hashed parts, so that the last
    task sees ``n * pieces`` rows of a hot key however many map tasks there
    were. Keys must not be null when ``hot`` is given. With ``ties`` the order need not
    be total: rows that tie with the last of the ``n`` stay, and equal rows have one rank.
    """
    place = F.rank() if ties else F.row_number()

    def ranked(part: DataFrame, by: Sequence[str]) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order)
        return part.withColumn(rank, place.over(window)).filter(F.col(rank) <= n)

    keys = list(keys)
    if hot is None:
        return ranked(df, keys)
    hot = F.broadcast(hot)
    cold = df.join(hot, keys, "left_anti")
    heavy = df.join(hot, keys, "left_semi").withColumn(
        _SALT, F.pmod(F.xxhash64(*df.columns), F.lit(pieces))
    )
    heavy = ranked(heavy, [*keys, _SALT]).drop(_SALT, rank)
    return ranked(cold, keys).unionByName(ranked(heavy, keys))
