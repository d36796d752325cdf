"""Lexicon sentiment over seasons and nations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.functions.bands import map_bin
from innsight.functions.dates import season
from innsight.operators.sentiment import Lexicon, with_sentiment
from innsight.plans.common import only, sorted_if


def _scored(reviews: DataFrame, lexicon: Lexicon, id_column: str | None) -> DataFrame:
    return with_sentiment(reviews, lexicon, id_column).withColumn("Season", season(F.col("Review_Date")))


def sentiment_by_season(
    reviews: DataFrame, lexicon: Lexicon, id_column: str | None = None
) -> DataFrame:
    return (
        _scored(reviews, lexicon, id_column)
        .groupBy("Season")
        .agg(F.avg("Sentiment_Score").alias("Avg_Sentiment_Score"))
        .orderBy("Season")
    )


def sentiment_by_hotel_season(
    reviews: DataFrame, lexicon: Lexicon, hotel: str | None = None, id_column: str | None = None
) -> DataFrame:
    # Sums per address first: a least address over all reviews would have them sorted.
    per_address = (
        _scored(only(reviews, "Hotel_Name", hotel), lexicon, id_column)
        .groupBy("Season", "Hotel_Name", "Hotel_Address")
        .agg(
            F.sum("Sentiment_Score").alias("_sentiment"),
            F.sum("Reviewer_Score").alias("_score"),
            F.count("Reviewer_Score").alias("_scored"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    stats = per_address.groupBy("Season", "Hotel_Name").agg(
        F.min("Hotel_Address").alias("Hotel_Address"),
        F.round(F.sum("_sentiment") / F.sum("_n"), 4).alias("Avg_Sentiment_Score"),
        F.round(F.try_divide(F.sum("_score"), F.sum("_scored")), 4).alias("Avg_Review_Score"),
        F.sum("_n").alias("Num_Reviews"),
    )
    return sorted_if(stats, hotel, "Season")


def sentiment_by_nation_season(
    reviews: DataFrame, lexicon: Lexicon, nation: str | None = None, id_column: str | None = None
) -> DataFrame:
    return (
        _scored(only(reviews, "Hotel_Nationality", nation), lexicon, id_column)
        .groupBy("Hotel_Nationality", "Season")
        .agg(F.avg("Sentiment_Score").alias("Avg_Sentiment_Score"))
        .orderBy("Hotel_Nationality", "Season")
    )


def best_and_worst_season(
    reviews: DataFrame, lexicon: Lexicon, nation: str | None = None, id_column: str | None = None
) -> DataFrame:
    """Season of highest and of lowest mean sentiment per nation; the first by name among equals."""
    score, name = F.col("Avg_Sentiment_Score"), F.col("Season")
    worst = F.min(F.struct(score, name))
    best = F.min(F.struct((-score).alias("minus"), name))
    return (
        sentiment_by_nation_season(reviews, lexicon, nation, id_column)
        .groupBy("Hotel_Nationality")
        .agg(best.alias("_best"), worst.alias("_worst"))
        .select(
            "Hotel_Nationality",
            F.col("_best.Season").alias("Best_Season"),
            (-F.col("_best.minus")).alias("Best_Sentiment"),
            F.col("_worst.Season").alias("Worst_Season"),
            F.col("_worst.Avg_Sentiment_Score").alias("Worst_Sentiment"),
        )
    )


def sentiment_by_nation(
    reviews: DataFrame, lexicon: Lexicon, id_column: str | None = None
) -> DataFrame:
    """Mean sentiment per nation of the hotels, with its bin on the map."""
    return (
        with_sentiment(reviews, lexicon, id_column)
        .groupBy(F.col("Hotel_Nationality").alias("nation"))
        .agg(F.round(F.avg("Sentiment_Score"), 3).alias("mean_sentiment"))
        .withColumn("bin", map_bin(F.col("mean_sentiment")))
    )


def sentiment_map(
    reviews: DataFrame, outlines: DataFrame, lexicon: Lexicon, id_column: str | None = None
) -> DataFrame:
    """Sentiment of each outlined nation (``name``), null where there are no reviews.

    Names are compared without regard to case: all spellings of a nation count
    together, and an outline has one row.
    """
    spelled_alike = reviews.withColumn("Hotel_Nationality", F.lower("Hotel_Nationality"))
    by_nation = sentiment_by_nation(spelled_alike, lexicon, id_column).select(
        F.col("nation").alias("_name"), F.col("mean_sentiment").alias("sentiment")
    )
    return (
        outlines.select("name", F.lower("name").alias("_name"))
        .join(by_nation, "_name", "left")
        .select("name", "sentiment", map_bin(F.col("sentiment")).alias("bin"))
    )
