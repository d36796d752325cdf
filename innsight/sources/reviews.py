"""Raw review files in, cleaned review table out."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.schema import RAW_COLUMNS


def read_raw(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """All CSV files under ``path`` with a header line, every column as a string.

    Columns are found by their names; others are left out, a missing one is an
    error. All files must have their columns in one order, else reading fails.
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("enforceSchema", False)
    return reader.option("mode", "PERMISSIVE").options(**options).csv(path).select(*RAW_COLUMNS)


#: Where a row of :func:`read_raw_stored` stands.
PLACE = ("_file", "_row")


def read_raw_stored(spark: SparkSession, path: str) -> DataFrame:
    """A raw table stored as Parquet, strings as in the files, with the place of each row: ``PLACE``."""
    found = spark.read.parquet(path)
    return found.select(
        *RAW_COLUMNS, F.col("_metadata.file_path").alias(PLACE[0]), F.col("_metadata.row_index").alias(PLACE[1])
    )


#: Columns of a file that are looked at where files differ in theirs.
WIDTH = 64


def read_raw_any_order(spark: SparkSession, path: str, width: int = WIDTH, **options: str) -> DataFrame:
    """As :func:`read_raw`, where each file has its columns in an order of its own, others among them.

    Lines are read by place, up to ``width`` fields; each file's header line says which
    of them are which, and meets the lines of its file in a join on their file, one
    short row per file. Lines equal to a header in all wanted columns are no data. A file
    without a full header ends the read with an error. The files are read twice.
    """
    cells = [f"_{k}" for k in range(width)]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in cells])
    reader = spark.read.schema(schema).option("header", False).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
    lines = reader.options(**options).csv(path).select(F.array(*cells).alias("_cells"), F.col("_metadata.file_path").alias("_file"))
    is_header = F.size(F.array_intersect("_cells", F.array(*map(F.lit, RAW_COLUMNS)))) == len(RAW_COLUMNS)
    places = F.array(*[F.array_position("_cells", F.lit(name)).cast("int") for name in RAW_COLUMNS])
    headers = lines.filter(is_header).groupBy("_file").agg(F.min(places).alias("_places"))
    missing = F.raise_error(F.concat(F.lit("no header line with all columns in "), "_file"))
    known = F.when(F.col("_places").isNull(), missing.cast("array<int>")).otherwise(F.col("_places"))
    rows = lines.filter(~is_header).join(headers, "_file", "left").withColumn("_places", known)
    return rows.select(
        *[F.element_at("_cells", F.element_at("_places", k + 1)).alias(name) for k, name in enumerate(RAW_COLUMNS)]
    )


def write_clean(reviews: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store the cleaned table as Parquet, one directory per hotel nation.

    The rebalance hint lets adaptive execution split a nation that holds much of
    the data over several files. Rows of a file are sorted by hotel, so a filter
    on a hotel skips row groups by their statistics. Files get the session's
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` before compression; raise it
    (to 1g, say) for very large tables, so that they don't end in many small files.
    """
    (
        reviews.hint("rebalance", "Hotel_Nationality")
        .sortWithinPartitions("Hotel_Nationality", "Hotel_Name")
        .write.mode(mode)
        .partitionBy("Hotel_Nationality")
        .parquet(path)
    )


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_bucketed(
    reviews: DataFrame, table: str, buckets: int, path: str | None = None, mode: str = "errorifexists"
) -> None:
    """Store the cleaned table in ``buckets`` buckets by hotel, as a table of the session's catalog.

    Questions per hotel need no shuffle on it: a bucket holds all reviews of its hotels, sorted
    by hotel in each file. A hotel with much of the data is written by several tasks,
    as several files of one bucket. Choose buckets of some hundred megabytes.
    """
    writer = (
        reviews.hint("rebalance", buckets, F.col("Hotel_Name"))
        .write.mode(mode)
        .bucketBy(buckets, "Hotel_Name")
        .sortBy("Hotel_Name")
    )
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def latest_date(spark: SparkSession, path: str, column: str = "Review_Date") -> datetime.date | None:
    """The greatest date of a stored table, read from the statistics in the files' footers alone; null if it has none.

    One small job. It runs in a session of its own, whose settings let the Parquet reader
    answer the aggregate; the caller's session keeps its own.
    """
    return _greatest(spark, path, column).first()[0]


def _greatest(spark: SparkSession, path: str, column: str) -> DataFrame:
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path).agg(F.max(column))
