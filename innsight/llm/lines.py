"""Removal of lines that many sites share.

Each line's sites go into a HyperLogLog sketch of the line's hash; sketches merge
in the aggregation, map side first. Where a sketch's estimate lies too near the
threshold to trust, the line's sites are counted exactly. A line of many sites is
boilerplate and stays only where it comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.llm.common import cut, unused

MIN_SITES = 5
#: Shorter lines are left alone: they recur by chance.
MIN_CHARS = 20
LOG_K = 12
#: Relative standard error of a sketch of 2^LOG_K registers, and how many of them an estimate is trusted beyond.
ERROR = 1.04 / (1 << LOG_K) ** 0.5
SURE = 6


#: Pieces that the occurrences of a line are dealt in where they meet what is known of the line.
SALTS = 16


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line that is long enough: row key (id, hash of the text), place, line hash, hash of the site."""
    return (
        docs.select(
            F.col("doc_id").alias("id"),
            F.xxhash64("text").alias("text_hash"),
            F.xxhash64("source").alias("site"),
            F.posexplode(split_lines(F.col("text"))).alias("place", "line"),
        )
        .filter((F.length("line") >= min_chars) & (F.length(F.trim("line")) > 0))
        .select(
            "id", "text_hash", "site", "place",
            F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
        )
    )


def _meet(lines: DataFrame, known: DataFrame) -> DataFrame:
    """Join lines to a table of few lines, one row each, which is repeated for each piece of a common line."""
    dealt = lines.withColumn("salt", F.pmod(F.xxhash64("id", "place"), F.lit(SALTS)))
    repeated = known.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return dealt.join(repeated, ["h1", "h2", "salt"])


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Hashes (h1, h2) of the lines found on ``min_sites`` sites or more, and where each comes first."""
    lines = _lines(docs, min_chars)
    margin = SURE * ERROR * min_sites + 1
    spread = (
        lines.groupBy("h1", "h2")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", LOG_K)).alias("sites"),
            F.min(F.struct("id", "text_hash", "place")).alias("first"),
        )
        .filter(F.col("sites") >= min_sites - margin)
    )
    spread = cut(spread.filter(F.col("sites") > 1))
    near = spread.filter(F.col("sites") <= min_sites + margin)
    exact = (
        _meet(lines, near.select("h1", "h2"))
        .groupBy("h1", "h2")
        .agg(F.count_distinct("site").alias("counted"))
    )
    return (
        spread.join(exact, ["h1", "h2"], "left")
        .filter(F.coalesce("counted", "sites") >= min_sites)
        .select("h1", "h2", "first")
    )


def _marked(docs: DataFrame, removed: str, min_sites: int, min_chars: int) -> DataFrame:
    """``docs`` with the places of lines taken out in a new column ``removed``; ``text`` loses those lines."""
    own_id, own_hash = unused(docs, "id_of_removed", "hash_of_removed")
    found = (
        _meet(_lines(docs, min_chars), boilerplate(docs, min_sites, min_chars))
        .filter(F.struct("id", "text_hash", "place") != F.col("first"))
        .groupBy(F.col("id").alias(own_id), F.col("text_hash").alias(own_hash))
        .agg(F.sort_array(F.collect_set("place")).alias(removed))
    )
    joined = docs.join(
        found, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(own_hash)), "left"
    ).drop(own_id, own_hash)
    left = F.array_join(
        F.filter(split_lines(F.col("text")), lambda line, place: ~F.array_contains(F.col(removed), place)), "\n"
    )
    return joined.withColumn("text", F.when(F.col(removed).isNull(), F.col("text")).otherwise(left))


def without_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, text, source among them) with ``removed``, the places of
    lines taken out (from 0, null if none); ``text`` loses those lines.

    A line counts from ``min_chars`` characters that are not all blank. Of a
    boilerplate line the first occurrence stays, by (doc_id, hash of the text,
    place), a null id first; rows that repeat both id and text are treated alike.
    A null source is a site of its own, a null text has one empty line and
    stays null. A column ``removed`` of ``docs`` is replaced.
    """
    return _marked(docs.drop("removed"), "removed", min_sites, min_chars)


def report(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, lines, lines removed, characters left and the MD5 of the text left."""
    rows = docs.select("doc_id", "source", "text")
    found = without_boilerplate(rows.withColumn("n_lines", F.size(split_lines(F.col("text"))).cast("long")), **options)
    return found.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars_left"),
        F.md5(F.coalesce("text", F.lit(""))).alias("md5_left"),
    )


def keep(docs: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of ``docs`` without boilerplate lines, with all their columns.

    A text that had words and has none left goes. ``n_chars``, where there is such
    a column, follows a text that lost lines. Other columns stay, whatever their names.
    """
    (removed,) = unused(docs, "removed")
    found = _marked(docs, removed, min_sites, min_chars).filter(
        F.col(removed).isNull() | F.col("text").rlike(r"[^ \t\n\x0B\f\r]")
    )
    if "n_chars" in docs.columns:
        own = docs.schema["n_chars"].dataType
        changed = F.when(F.col(removed).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(own))
        found = found.withColumn("n_chars", changed)
    return found.drop(removed)


#: DuckDB: the same report by exact counts. One statement over ``documents``.
REPORT_SQL = f"""
with numbered as (
  select doc_id, source, text, row_number() over () as row_no from documents
), lines as (
  select row_no, doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place from numbered
), long_lines as (
  select * from lines where length(line) >= {MIN_CHARS} and trim(line) <> ''
), shared as (
  select line, min((doc_id, place)) as first from long_lines
  group by line having count(distinct source) + max(case when source is null then 1 else 0 end) >= {MIN_SITES}
), marked as (
  select l.row_no, l.place from long_lines l join shared s on l.line = s.line where (l.doc_id, l.place) <> s.first
), flagged as (
  select l.*, m.place is not null as gone from lines l left join marked m using (row_no, place)
)
select any_value(doc_id) as doc_id, count(*) as n_lines, cast(sum(gone::int) as bigint) as n_removed,
  length(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as chars_left,
  md5(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as md5_left
from flagged group by row_no
"""
