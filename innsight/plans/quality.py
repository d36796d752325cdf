"""What is missing in a table: one aggregate for all columns, one pass."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.functions.text import is_blank


def _missing(field: T.StructField, blanks: bool) -> Column:
    column = F.col(f"`{field.name}`")
    if blanks and isinstance(field.dataType, T.StringType):
        return is_blank(column)
    return column.isNull()


def _counts(df: DataFrame, blanks: bool, *, shown: dict[str, Column]) -> DataFrame:
    counted = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[
            F.count_if(~_missing(field, blanks)).alias(f"_{i}")
            for i, field in enumerate(df.schema.fields)
        ],
    )
    rows = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col(f"_{i}").alias("non_null"),
            F.col("_total").alias("total"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    per_column = counted.select(F.explode(F.array(*rows)).alias("_row")).select("_row.*")
    return per_column.select(*[column.alias(name) for name, column in shown.items()])


def null_profile(df: DataFrame) -> DataFrame:
    """Filled and missing values per column; a blank string is missing."""
    return _counts(
        df,
        blanks=True,
        shown={
            "column": F.col("column"),
            "non_null": F.col("non_null"),
            "missing": F.col("total") - F.col("non_null"),
        },
    )


def non_null_counts(df: DataFrame) -> DataFrame:
    """Non-null values per column beside the number of rows; a blank string counts."""
    return _counts(
        df,
        blanks=False,
        shown={name: F.col(name) for name in ("column", "non_null", "total")},
    )


def table_info(df: DataFrame) -> DataFrame:
    """Column, type and non-null count."""
    return _counts(
        df, blanks=False, shown={name: F.col(name) for name in ("column", "type", "non_null")}
    )


def rows_with_blanks(df: DataFrame) -> DataFrame:
    """Rows in which any column is null or blank."""
    return df.filter(reduce(or_, [_missing(field, blanks=True) for field in df.schema.fields]))


def peek(df: DataFrame, rows: int = 20) -> None:
    """Print the schema and the first rows."""
    df.printSchema()
    df.show(rows, truncate=False)
