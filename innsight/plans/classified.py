"""Sentiment from a classifier: labels per review counted per hotel.

``label`` is a column giving ``positive``, ``neutral`` or ``negative`` for the
combined review. It comes from a model (:func:`model_label`) or, by default,
from the lexicon score.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.functions.bands import label_from_score, sentiment_band, sentiment_sentence
from innsight.functions.dates import NO_SEASON, season
from innsight.functions.text import combined_review, is_blank, label_prompt, parse_label
from innsight.operators.late import top_n_late
from innsight.operators.scoring import Scorer, score_text
from innsight.operators.sentiment import Lexicon, compound, lexicon_score, review_words, with_sentiment
from innsight.operators.skew import HOT_ROWS, hot_keys, top_n
from innsight.plans.common import only, sorted_if


TEXTS = ("Positive_Review", "Negative_Review")


def _parts() -> tuple[Column, Column]:
    return F.col(TEXTS[0]), F.col(TEXTS[1])


def model_label(make_scorer: Callable[[], Scorer]) -> Column:
    """Label given by a model; a review without any text is neutral."""
    positive, negative = _parts()
    scored = score_text(combined_review(positive, negative), make_scorer)
    return F.when(is_blank(positive) & is_blank(negative), "neutral").otherwise(scored)


def with_lexicon_label(reviews: DataFrame, lexicon: Lexicon, id_column: str | None = None) -> tuple[DataFrame, Column]:
    """Reviews and the label of their lexicon score, for a lexicon of either form."""
    if not isinstance(lexicon, DataFrame):
        return reviews, lexicon_label(lexicon)
    scored = with_sentiment(reviews, lexicon, id_column, out="_sentiment")
    return scored, label_from_score(F.col("_sentiment"), 0.05)


def lexicon_label(lexicon: Mapping[str, float], limit: float = 0.05) -> Column:
    """Label of the lexicon sentiment score, without leaving the JVM."""
    return lexicon_score(
        review_words(*_parts()), lexicon, lambda total: label_from_score(compound(total), limit)
    )


def hotel_sentiment(reviews: DataFrame, label: Column, hotel: str | None = None) -> DataFrame:
    """Label counts per hotel, their net share and a verdict."""
    labelled = only(reviews, "Hotel_Name", hotel).select(
        "Hotel_Name", "Hotel_Address", label.alias("_label")
    )
    said = F.col("_label")
    net = F.col("Positive_Count") - F.col("Negative_Count")
    counts = {"positive": "Positive_Count", "neutral": "Neutral_Count", "negative": "Negative_Count"}
    # Counts per address first: a least address over all reviews would have them sorted.
    per_address = labelled.groupBy("Hotel_Name", "Hotel_Address").agg(
        F.count(F.lit(1)).alias("Num_Reviews"),
        *[F.count_if(said == name).alias(column) for name, column in counts.items()],
    )
    return (
        per_address.groupBy("Hotel_Name")
        .agg(
            F.min("Hotel_Address").alias("Hotel_Address"),
            *[F.sum(column).alias(column) for column in ("Num_Reviews", *counts.values())],
        )
        .withColumn("Average_Sentiment_Score", F.bround(net / F.col("Num_Reviews"), 3))
        .withColumn("Sentiment", sentiment_sentence(F.col("Hotel_Name"), F.col("Average_Sentiment_Score")))
        .withColumn("band", sentiment_band(F.col("Average_Sentiment_Score")))
    )


def seasonal_label_stats(
    reviews: DataFrame,
    make_scorer: Callable[[], Scorer],
    per_season: int = 1,
    hotel: str | None = None,
    order: tuple[str, ...] = ("Review_Date", "Positive_Review", "Negative_Review", "Reviewer_Score"),
    hot_rows: int | None = HOT_ROWS,
    id_column: str | None = None,
) -> DataFrame:
    """Mean label and score of the first ``per_season`` reviews of each hotel and season.

    The model is given an instruction with each review
    (:func:`innsight.functions.text.label_prompt`) and writes free text, read by
    :func:`innsight.functions.text.parse_label`; no answer counts as 0. It sees the
    chosen reviews only. With ``id_column``, a unique key of the rows, reviews are
    ranked without their texts (by the id, where ``order`` leaves a tie) and the
    texts of the chosen ones read afterwards.
    """
    positive, negative = _parts()
    keys = ["Hotel_Name", "Season"]
    dated = only(reviews, "Hotel_Name", hotel).withColumn("Season", season(F.col("Review_Date")))
    dated = dated.filter(F.col("Season") != NO_SEASON)
    columns = dict.fromkeys(
        ["Hotel_Name", "Hotel_Address", "Season", "Positive_Review", "Negative_Review", "Reviewer_Score", *order]
    )
    if id_column is None:
        hot = None if hot_rows is None else hot_keys(dated, keys, hot_rows)
        chosen = top_n(dated.select(*columns), keys, [F.asc(name) for name in order], per_season, hot=hot)
    else:
        # A score in the order is ranked by, like the other narrow columns.
        wide = [name for name in columns if name not in (*keys, id_column, *set(order) - set(TEXTS))]
        chosen = top_n_late(dated, keys, order, per_season, id_column, wide, hot_rows=hot_rows)
    labelled = chosen.withColumn(
        "_label", parse_label(score_text(label_prompt(combined_review(positive, negative)), make_scorer))
    )
    stats = labelled.groupBy(*keys).agg(
        F.min("Hotel_Address").alias("Hotel_Address"),
        F.round(F.avg("_label"), 4).alias("Avg_Sentiment_Score"),
        F.round(F.avg("Reviewer_Score"), 4).alias("Avg_Review_Score"),
        F.count(F.lit(1)).alias("Num_Reviews"),
    )
    return sorted_if(stats, hotel, "Season").select(
        "Hotel_Name", "Hotel_Address", "Season", "Avg_Sentiment_Score", "Avg_Review_Score", "Num_Reviews"
    )
