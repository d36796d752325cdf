"""Token counts by a map-side lookup in two tiers.

The commonest pre-tokens of all documents are found by a frequent-items sketch,
their numbers of tokens go to every task as one small table, and the rest is
encoded where it is met, through a cache of the worker. No pre-token is shuffled;
the tiers change the speed only.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries of the broadcast table (a few MB at most) and of the sketch behind it.
TABLE_SIZE = 20_000
SKETCH_SIZE = 65_536
SKETCH_GROUPS = 64
#: Longer pre-tokens are encoded but neither broadcast nor cached.
CACHED_CHARS = 64
CACHED = 250_000

_MODELS: dict[str, object] = {}
_CACHES: dict[str, list[dict[str, int]]] = {}

BLANK = "▁"


def model(path: str):
    """The vocabulary, checked for pieces that would make the cuts wrong; one per worker."""
    if path not in _MODELS:
        import sentencepiece

        found = sentencepiece.SentencePieceProcessor(model_file=path)
        for n in range(found.get_piece_size()):
            piece = found.id_to_piece(n)
            if BLANK in piece.lstrip(BLANK) or "\n" in piece:
                raise ValueError("a piece runs over a blank or a line feed: texts can't be split there")
        gc.set_threshold(1_000_000, 20, 50)
        _MODELS[path], _CACHES[path] = found, [{}, {}]
    return _MODELS[path]


def pre_tokens(text: Column) -> Column:
    """A text cut before each blank and each line feed, as an array.

    Each but the first has lost a blank at its front, unless it starts with a
    line feed. An empty one stands for a blank by itself.
    """
    return F.split(F.replace(F.replace(text, F.lit(BLANK), F.lit(" ")), F.lit("\n"), F.lit(" \n")), " ", -1)


def frequent(docs: DataFrame, size: int = TABLE_SIZE, tracked: int = SKETCH_SIZE) -> list[str]:
    """The commonest pre-tokens of all texts, about. Only sketches of bounded size leave the tasks."""
    found = docs.select(F.explode(pre_tokens(F.col("text"))).alias("piece")).filter(
        F.length("piece").between(1, CACHED_CHARS)
    )
    # Sketches of many tasks meet in a fixed number of groups; what those report is added up.
    reported = found.groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("g")).agg(
        F.expr(f"approx_top_k(piece, {size}, {tracked})").alias("top")
    )
    total = (
        reported.select(F.explode("top").alias("t"))
        .groupBy(F.col("t.item").alias("piece"))
        .agg(F.sum("t.count").alias("n"))
    )
    return [row.piece for row in total.orderBy(F.desc("n"), "piece").limit(size).collect()]


def _lengths(pieces: list[str], path: str) -> list[int]:
    """Tokens of each pre-token. The library puts a blank before whatever it encodes: the one that a
    pre-token has lost, or one too many before a line feed, with which no piece joins it."""
    found = model(path).encode(pieces, num_threads=1)
    return [1 if p == "" else len(n) - (p[0] == "\n") for p, n in zip(pieces, found, strict=True)]


class Counter:
    """Counts the tokens of texts: first tier ``table``, second tier the worker's cache."""

    def __init__(self, path: str, table: dict[str, int]):
        model(path)
        self.table, self.path = table, path
        self.caches = _CACHES[path]

    def count(self, text: str) -> int:
        if not text:
            return 0
        # The library puts a blank before the text: the first part's.
        parts = text.replace(BLANK, " ").replace("\n", " \n").split(" ")
        if "" in parts:
            parts = self._joined(parts)
        table, known = self.table, self.caches[0]
        total, missing = 0, []
        for part in parts:
            n = table.get(part)
            if n is None:
                n = known.get(part)
                if n is None:
                    missing.append(part)
                    continue
            total += n
        return total + self._encode(missing) if missing else total

    @staticmethod
    def _joined(parts: list[str]) -> list[str]:
        """Blanks that nothing follows go to the front of what comes next, or stand alone before a line feed."""
        out, blanks = [], 0
        for part in parts:
            if part == "":
                blanks += 1
            elif part[0] == "\n":
                if blanks:
                    out.append(" " * (blanks - 1))
                out.append(part)
                blanks = 0
            else:
                out.append(" " * blanks + part)
                blanks = 0
        if blanks:
            out.append(" " * (blanks - 1))
        return out

    def _encode(self, pieces: list[str]) -> int:
        newer, older = self.caches
        total, missing = 0, []
        for piece in pieces:
            n = older.get(piece)
            if n is None:
                missing.append(piece)
            else:
                newer[piece] = n
                total += n
        for piece, n in zip(missing, _lengths(missing, self.path), strict=True):
            total += n
            if len(piece) <= CACHED_CHARS:
                newer[piece] = n
        if len(newer) > CACHED:
            self.caches[:] = [{}, newer]
        return total


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, table_size: int = TABLE_SIZE) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row (doc_id, text; other columns are ignored).

    A null text counts as empty. Texts are read whole.
    """
    spark = docs.sparkSession
    pieces = frequent(docs, table_size)
    table = spark.sparkContext.broadcast(dict(zip(pieces, _lengths(pieces, path), strict=True)))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(path, table.value)
        for batch in batches:
            yield pa.array([counter.count(text or "") for text in batch.to_pylist()], type=pa.int64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    n_tokens = F.arrow_udf(run, "long")(F.col("text"))
    return docs.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        n_tokens.alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
