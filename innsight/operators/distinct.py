"""Distinct counts that can be kept and merged: HyperLogLog sketches as a column of a table.

A sketch of a group is a few kilobytes at most, whatever it has counted. Sketches of
days, files or cities merge into those of any union of them without a look at the
rows again, which exact counts can't. Up to about ``2 ** lg_k / 32`` distinct values
the count is exact or nearly so; beyond, its relative standard error is
:func:`relative_error`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14


def relative_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a merged sketch of ``2 ** lg_k`` registers."""
    return 1.04 / (1 << lg_k) ** 0.5


def distinct_sketch(column: str, lg_k: int = LG_K) -> Column:
    """Aggregate: a sketch of the distinct values of a column. Nulls don't count."""
    return F.hll_sketch_agg(column, lg_k)


def merge_sketches(sketches: DataFrame, sketch: str, *by: str) -> DataFrame:
    """One sketch per ``by`` of all that its rows stand for; they may have been made at different precisions."""
    return sketches.groupBy(*by).agg(F.hll_union_agg(sketch, True).alias(sketch))


def estimate(sketch: str) -> Column:
    return F.hll_sketch_estimate(sketch)
