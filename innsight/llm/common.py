"""Helpers shared by the operators: shipping the package, text functions in Arrow batches, shared folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD_BREAKS = " \t\n\x0b\f\r"

_ARROW = {
    T.LongType: pa.int64(),
    T.IntegerType: pa.int32(),
    T.DoubleType: pa.float64(),
    T.BooleanType: pa.bool_(),
    T.StringType: pa.string(),
    T.BinaryType: pa.binary(),
}


def arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.StructType):
        return pa.struct([(field.name, arrow_type(field.dataType)) for field in kind])
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    return _ARROW[type(kind)]


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder it was imported from.

    Enough where executors see that folder; on other clusters install the package
    or pass it with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *known])


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, a new local one is set if all tasks run on this machine."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of a DataFrame with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def sample(df: DataFrame, limit: int, pieces: int = 64) -> DataFrame:
    """At most ``limit`` different rows, those of least hash over all columns: the same ones on each run.

    The least of each piece come first, so that few rows meet in the end however many tasks there are.
    """
    rank, piece = unused(df, "rank_in_piece", "piece_of_sample")
    hashed = F.xxhash64(*df.columns)
    order = Window.partitionBy(piece).orderBy(hashed, *df.columns)
    ranked = df.distinct().withColumn(piece, F.pmod(hashed, F.lit(pieces))).withColumn(rank, F.row_number().over(order))
    return ranked.filter(F.col(rank) <= limit).select(*df.columns).orderBy(hashed, *df.columns).limit(limit)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, made longer until no column of the DataFrame has them."""
    taken, out = {column.lower() for column in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def per_text(make: Callable[[], Callable[[str | None], object]], returns: str) -> Callable[[Column], Column]:
    """A Spark function of one text column, run in Arrow batches.

    ``make`` runs once per task on the executor and returns a function of one
    text; for a struct result that function returns a tuple in field order.
    """
    kind = arrow_type(T._parse_datatype_string(returns))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = make()
        for batch in batches:
            yield pa.array([one(text) for text in batch.to_pylist()], type=kind)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, returns)
