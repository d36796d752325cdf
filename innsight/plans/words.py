"""What reviews are made of: words, tags, lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.functions.text import strip_punctuation, words
from innsight.operators.late import fetch
from innsight.operators.skew import top_n
from innsight.schema import IMPUTED

KINDS = {"positive": "Positive_Review", "negative": "Negative_Review"}
# Parts of speech taken as adjective or adverb.
POS_KEPT = ("a", "r")
MIN_COUNT = 1000


def word_scores(
    reviews: DataFrame,
    dictionary: DataFrame,
    min_frequency: int = MIN_COUNT,
    kinds: tuple[str, ...] = ("positive", "negative"),
    exclude_imputed: bool = False,
    bare_words: bool = False,
) -> DataFrame:
    """Mean score and frequency of each adjective and adverb, by kind of text.

    ``dictionary`` has ``word`` and ``pos``. Both kinds come from one pass. Words
    are summed up first and the frequent ones looked up, so the plan is the same
    for a dictionary of any size. Words are looked up as they stand between
    blanks, or without outer punctuation if ``bare_words``.
    """
    wanted = dictionary.filter(F.col("pos").isin(*POS_KEPT)).select("word").distinct()
    columns = [KINDS[kind] for kind in kinds]
    texts = reviews.select("Reviewer_Score", *columns)
    if len(kinds) == 1:
        texts = texts.select(
            "Reviewer_Score", F.lit(kinds[0]).alias("type"), F.col(columns[0]).alias("text")
        )
    else:
        texts = texts.unpivot("Reviewer_Score", columns, "type", "text").withColumn(
            "type", F.when(F.col("type") == KINDS["positive"], "positive").otherwise("negative")
        )
    if exclude_imputed:
        texts = texts.filter(~F.col("text").isin(*[IMPUTED[name] for name in KINDS.values()]))
    found = texts.select("Reviewer_Score", "type", F.explode(words(F.col("text"))).alias("word"))
    if bare_words:
        found = found.withColumn("word", strip_punctuation(F.col("word")))
    found = found.filter(F.col("word") != "")

    scores = (
        found.groupBy("type", "word")
        .agg(F.avg("Reviewer_Score").alias("avg_score"), F.count(F.lit(1)).alias("word_count"))
        .filter(F.col("word_count") >= min_frequency)
    )
    return scores.join(wanted, "word", "left_semi").select("type", "word", "avg_score", "word_count")


def _first(df: DataFrame, order: list[Column], n: int | None) -> DataFrame:
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def positive_word_scores(
    reviews: DataFrame, dictionary: DataFrame, min_frequency: int = MIN_COUNT, n: int | None = None, **options
) -> DataFrame:
    """Words of positive texts, those with the best scores first."""
    scores = word_scores(reviews, dictionary, min_frequency, ("positive",), **options)
    return _first(scores.drop("type"), [F.desc("avg_score"), F.asc("word")], n)


def negative_word_scores(
    reviews: DataFrame, dictionary: DataFrame, min_frequency: int = MIN_COUNT, n: int | None = None, **options
) -> DataFrame:
    """Words of negative texts, those with the worst scores first."""
    scores = word_scores(reviews, dictionary, min_frequency, ("negative",), **options)
    return _first(scores.drop("type"), [F.asc("avg_score"), F.asc("word")], n)


def tag_frequency(reviews: DataFrame) -> DataFrame:
    counted = reviews.select(F.explode("Tags").alias("word")).groupBy("word").count()
    return counted.orderBy(F.desc("count"), F.asc("word"))


def most_used_tags(reviews: DataFrame, n: int = 10) -> DataFrame:
    return tag_frequency(reviews).limit(n)


def least_used_tags(reviews: DataFrame, n: int = 10) -> DataFrame:
    """The tail of :func:`tag_frequency`, rarest first."""
    return tag_frequency(reviews).orderBy(F.asc("count"), F.desc("word")).limit(n)


def tag_influence(reviews: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """Mean score of the reviews carrying each frequent tag, best first."""
    return (
        reviews.select("Reviewer_Score", F.explode("Tags").alias("tag"))
        .groupBy("tag")
        .agg(F.avg("Reviewer_Score").alias("avg_score"), F.count(F.lit(1)).alias("tag_count"))
        .filter(F.col("tag_count") >= min_count)
        .orderBy(F.desc("avg_score"), F.asc("tag"))
    )


def review_length_extremes(
    reviews: DataFrame, by: str | None = None, id_column: str | None = None
) -> DataFrame:
    """Longest and shortest positive and negative review, over all or per ``by``.

    Among texts of equal length the least (hotel, city, score, text) is taken.
    Over all, the four come from one aggregate over one pass. Per ``by``, the
    extreme lengths are found first, as numbers, and ties are broken among the
    texts of those lengths alone, so that no task sorts all its texts. With
    ``id_column``, a unique key of the rows, lengths, hashes and ids alone are
    shuffled, and a text is read only where it ties to the end.
    """
    # Names of the two kinds of text.
    named = {"positiva": "Positive_Review", "negativa": "Negative_Review"}
    fields = ["Hotel_Name", "Hotel_City", "Reviewer_Score"]
    if by is None:
        return _extremes_of_all(reviews, named, fields)
    keys = [f"by_{by}", "type"]
    if id_column is None:
        near = _near_extremes(_texts_by_kind(reviews, by, named, fields, ["review_text"]), keys)
    else:
        narrow = _near_extremes(_texts_by_kind(reviews, by, named, fields, [id_column, "_hash"]), keys)
        # Of equal texts that tie one is read.
        group = [*keys, "_which", "length", *fields]
        alike = narrow.groupBy(*group, "_hash").agg(F.min(id_column).alias(id_column)).drop("_hash")
        tied = top_n(alike, [*keys, "_which"], [F.asc(name) for name in fields], 1, ties=True).drop("rank")
        text = F.when(F.col("type") == "positiva", F.col(named["positiva"])).otherwise(F.col(named["negativa"]))
        near = fetch(tied, reviews, id_column, list(named.values())).withColumn("review_text", text)
    least = F.min(F.struct(*fields, "review_text")).alias("_row")
    return (
        near.groupBy(*keys, "_which", "length")
        .agg(least)
        .select(keys[0], "_row.review_text", "_row.Reviewer_Score", "_row.Hotel_Name", "_row.Hotel_City", "type", "length")
    )


def _texts_by_kind(
    reviews: DataFrame, by: str, named: dict[str, str], fields: list[str], wanted: list[str]
) -> DataFrame:
    """A row per text that is there: key, kind, fields, length and what else is wanted of it."""

    def of(kind: str, column: str) -> Column:
        text = F.col(column)
        parts = [F.lit(kind).alias("type"), F.length(text).alias("length")]
        offered = {"review_text": text.alias("review_text"), "_hash": F.xxhash64(text).alias("_hash")}
        return F.struct(*parts, *[offered[name] for name in wanted if name in offered])

    rows = reviews.select(
        F.col(by).alias(f"by_{by}"),
        *fields,
        *[name for name in wanted if name not in ("review_text", "_hash")],
        F.inline(F.array(*[of(kind, column) for kind, column in named.items()])),
    )
    return rows.filter(F.col("length").isNotNull())


def _near_extremes(texts: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the greatest and of the least length of each key, ``_which`` of the two in a column."""
    bounds = (
        texts.groupBy(*keys)
        .agg(F.max("length").alias("_long"), F.min("length").alias("_short"))
        .select(
            F.col(keys[0]).alias("_by"),
            F.col("type").alias("_type"),
            F.explode(
                F.array(
                    F.struct(F.lit("long").alias("which"), F.col("_long").alias("at")),
                    F.struct(F.lit("short").alias("which"), F.col("_short").alias("at")),
                )
            ).alias("_bound"),
        )
    )
    near = texts.join(
        bounds,
        F.col(keys[0]).eqNullSafe(F.col("_by"))
        & (F.col("type") == F.col("_type"))
        & (F.col("length") == F.col("_bound.at")),
    )
    return near.withColumn("_which", F.col("_bound.which")).drop("_by", "_type", "_bound")


def _extremes_of_all(reviews: DataFrame, named: dict[str, str], fields: list[str]) -> DataFrame:
    extremes, rows = [], []
    for kind, column in named.items():
        size = F.length(column)
        for which, key in (("long", -size), ("short", size)):
            name = f"_{kind}_{which}"
            row = F.struct(key.alias("key"), *fields, F.col(column).alias("review_text"))
            extremes.append(F.min(F.when(F.col(column).isNotNull(), row)).alias(name))
            rows.append(
                F.struct(
                    F.col(f"{name}.review_text").alias("review_text"),
                    *[F.col(f"{name}.{field}").alias(field) for field in ("Reviewer_Score", "Hotel_Name", "Hotel_City")],
                    F.lit(kind).alias("type"),
                    F.abs(F.col(f"{name}.key")).alias("length"),
                )
            )
    found = reviews.agg(*extremes)
    return found.select(F.explode(F.array(*rows)).alias("_row")).select("_row.*").filter(F.col("length").isNotNull())
