"""Lexicon sentiment of a review: the valences of its words summed, then
brought into [-1, 1] by ``s / sqrt(s * s + 15)`` (Hutto and Gilbert, 2014).

The text is ``"{positive}. {negative}"``, lower-cased, cut at whitespace, outer
punctuation taken off each word. A review without a word of the lexicon is 0.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.functions.text import combined_review, strip_punctuation, words
from innsight.operators.late import only_ids
from innsight.operators.skew import HOT_ROWS, frequent_keys, spread_join

NORMALISATION = 15.0  # fixed value

Lexicon = Mapping[str, float] | DataFrame


def compound(total: Column) -> Column:
    return total / F.sqrt(total * total + NORMALISATION)


def review_words(reviews_positive: Column, reviews_negative: Column) -> Column:
    return words(F.lower(combined_review(reviews_positive, reviews_negative)))


def lexicon_score(
    tokens: Column,
    lexicon: Mapping[str, float],
    finish: Callable[[Column], Column] = compound,
) -> Column:
    """``finish`` of the summed valences of an array of words, without a join.

    The lexicon travels with the plan as a constant: an array of small maps, one
    of which is picked by the word's checksum, so a look-up takes constant time.
    It is sent with every task; a table is the other form, joined to the words.
    ``finish`` runs inside the fold, on the sum, so the words are walked once.
    """
    # One JSON literal, folded by the optimizer: thousands of single literals
    # would take seconds to hand over to the JVM.
    slots = 1 << max(len(lexicon) // 8, 1).bit_length()
    table: list[dict[str, float]] = [{} for _ in range(slots)]
    for word, valence in lexicon.items():
        table[zlib.crc32(word.encode()) % slots][word] = float(valence)
    constant = F.from_json(F.lit(json.dumps(table, ensure_ascii=False)), "array<map<string,double>>")

    def add(total: Column, word: Column) -> Column:
        slot = (F.crc32(word.cast("binary")) % slots).cast("int")
        return total + F.coalesce(F.try_element_at(F.get(constant, slot), word), F.lit(0.0))

    return F.aggregate(F.transform(tokens, strip_punctuation), F.lit(0.0), add, finish)


def with_sentiment(
    reviews: DataFrame,
    lexicon: Lexicon,
    id_column: str | None = None,
    out: str = "Sentiment_Score",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """``reviews`` with a sentiment score per row.

    A lexicon given as a mapping is a projection: no shuffle, no join. A lexicon
    given as a table (``word``, ``valence``) may have any size; it is joined to
    the words of each review and needs ``id_column``, a unique key of the rows. Words
    are compared in lower case; of a word that is listed twice the least valence holds.

    Words that the lexicon lacks are dropped where they are read, by a bit map of its
    words of fixed size, so what is shuffled grows with the words found. The words of
    a review are summed up before the join. A word of more than about
    ``hot_rows`` reviews is dealt to several tasks, by the review's id, and its
    entry of the lexicon goes to each of them; with ``None`` the words are not looked
    through for such, which spares a reading of the texts where the lexicon is small.
    """
    tokens = review_words(F.col("Positive_Review"), F.col("Negative_Review"))
    if not isinstance(lexicon, DataFrame):
        return reviews.withColumn(out, lexicon_score(tokens, lexicon))
    if id_column is None:
        raise ValueError("a lexicon table needs id_column, a unique key of the reviews")
    return (
        reviews.join(_totals(reviews.select(id_column, tokens.alias("_words")), lexicon, id_column, hot_rows), id_column, "left")
        .withColumn(out, compound(F.coalesce(F.col("_total"), F.lit(0.0))))
        .drop("_total")
    )


def _totals(worded: DataFrame, lexicon: DataFrame, id_column: str, hot_rows: int | None) -> DataFrame:
    """The summed valences of each review (id, ``_words``) that has a word of the lexicon."""
    valences = lexicon.groupBy(F.lower("word").alias("word")).agg(F.min("valence").alias("valence"))
    found = _listed(worded, valences, id_column)
    times = found.groupBy(id_column, "word").agg(F.count(F.lit(1)).alias("_times"))
    if hot_rows is None:
        hits = times.join(valences, "word")
    else:
        hot = F.broadcast(frequent_keys(found, "word", hot_rows, "_rows"))
        weighed = valences.join(hot, "word", "left").withColumn("_rows", F.coalesce("_rows", F.lit(1)))
        hits = spread_join(times, weighed, "word", "_rows", [id_column], hot_rows)
    return hits.groupBy(id_column).agg(F.sum(F.col("_times") * F.col("valence")).alias("_total"))


def _listed(worded: DataFrame, valences: DataFrame, id_column: str) -> DataFrame:
    """(id, ``word``) of each word that may be in the lexicon: all that are, and few others. No shuffle of the words."""
    found = worded.select(id_column, F.explode("_words").alias("word"))
    return only_ids(found.withColumn("word", strip_punctuation(F.col("word"))), valences, "word")
