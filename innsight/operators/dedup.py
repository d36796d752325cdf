"""Whole-row copies, dropped without a shuffle of the rows.

A row's digest and its place (file and number, say) are shuffled, a few dozen bytes.
The places of copies then go out as the bit map of :mod:`innsight.operators.late`.
Rows that it does not name stay where they are read. The few others, copies and rows
named by chance, are compared with the places themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.operators.late import marked


def drop_copies(df: DataFrame, columns: Sequence[str], place: Sequence[str]) -> DataFrame:
    """``df`` with one row of those equal in ``columns``, nulls being equal: the first by ``place``.

    ``place`` names columns that tell all rows apart and are the same whenever the
    rows are read again. Rows are told equal by 128 bits of a digest. The more copies
    there are, the more rows pass through the comparison in the end.
    """
    digest = F.unhex(F.md5(F.to_json(F.struct(*columns)))).alias("_digest")
    at = F.struct(*place)
    narrow = df.select(digest, at.alias("_at"))
    first = narrow.groupBy("_digest").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    copied = first.filter(F.col("_n") > 1).select("_digest", "_first")
    gone = narrow.join(copied, "_digest").filter(F.col("_at") != F.col("_first")).select("_at")
    rows = marked(df.withColumn("_at", at), gone, "_at", "_named")
    doubtful = rows.filter("_named").join(gone, "_at", "left_anti").select(*df.columns)
    return rows.filter("not _named").select(*df.columns).unionByName(doubtful)
