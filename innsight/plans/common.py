"""Shared by the analyses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def only(df: DataFrame, column: str, value: str | None) -> DataFrame:
    return df if value is None else df.filter(F.col(column) == value)


def sorted_if(df: DataFrame, wanted: object, *order: Column | str) -> DataFrame:
    """Sort the answer for one hotel; a whole-table answer is left unsorted, as
    a global sort of it would be a shuffle nobody asked for."""
    return df if wanted is None else df.orderBy(*order)
