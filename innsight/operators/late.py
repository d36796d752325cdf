"""Late materialisation: choose rows by narrow columns, then read the wide ones of the chosen rows.

A join back by row id would send the wide columns of all rows through a shuffle,
and the chosen ids may be too many to broadcast. So a bit map of their hashes goes
out first. It has a fixed size whatever the data, drops nearly all other rows where
they are read, and what it lets through by chance the join by id drops. Everything
is one plan: no job is started, and no size is looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import takewhile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.operators.skew import hot_keys, top_n

#: Words of 64 bits of the map: at most this many rows of 16 bytes are broadcast.
MAP_WORDS = 1 << 20


def _place(row_id: Column) -> Column:
    return F.pmod(F.xxhash64(row_id), F.lit(MAP_WORDS * 64))


def _word(place: Column) -> Column:
    return F.shiftright(place, 6)


def marked(table: DataFrame, ids: DataFrame, id_column: str, out: str) -> DataFrame:
    """``table`` with a boolean column ``out``: true for all rows whose id is among ``ids``, and few others.

    No shuffle of ``table``.
    """
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64({id_column}), 64) as int))")
    word = _word(_place(F.col(id_column)))
    marks = ids.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    held = table.withColumn("_word", word).join(F.broadcast(marks), "_word", "left")
    named = F.coalesce(F.col("_bits"), F.lit(0)).bitwiseAND(bit) != 0
    return held.withColumn(out, named).drop("_word", "_bits")


def only_ids(table: DataFrame, ids: DataFrame, id_column: str) -> DataFrame:
    """Rows of ``table`` whose id may be among ``ids``: all that are, and few others. No shuffle of ``table``."""
    return marked(table, ids, id_column, "_named").filter("_named").drop("_named")


def fetch(chosen: DataFrame, table: DataFrame, id_column: str, columns: Sequence[str]) -> DataFrame:
    """``chosen`` with ``columns`` of the rows of ``table`` that have its ids.

    Ids must be unique in ``table``, may repeat in ``chosen`` and must not be null.
    """
    wide = only_ids(table.select(id_column, *columns), chosen, id_column)
    return chosen.join(wide, id_column)


def top_n_late(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    n: int,
    id_column: str,
    wide: Sequence[str],
    rank: str = "rank",
    hot_rows: int | None = None,
) -> DataFrame:
    """First ``n`` rows of each key by ``order``, all ascending and ending in the id, with their rank.

    Rows are ranked without the ``wide`` columns, which are read for the chosen rows
    alone. An order may have wide columns too, after narrow ones: then rows that tie
    at the cut by the narrow ones are read as well, and ranked by all.
    """
    keys, first = list(keys), list(takewhile(lambda name: name not in wide, order))
    narrow = df.select(*dict.fromkeys([*keys, *[name for name in order if name not in wide], id_column]))
    hot = None if hot_rows is None else hot_keys(narrow, keys, hot_rows)
    whole = [F.asc(name) for name in dict.fromkeys([*order, id_column])]
    if len(first) == len(order):
        return fetch(top_n(narrow, keys, whole, n, rank, hot), df, id_column, wide)
    tied = top_n(narrow, keys, [F.asc(name) for name in first], n, rank, hot, ties=True).drop(rank)
    return top_n(fetch(tied, df, id_column, wide), keys, whole, n, rank)
