"""Every analysis on the given tables: name to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import string
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.functions.text import strip_reasoning
from innsight.plans import classified, digest, hotels, ingest, nearby, places, quality, seasons, words
from innsight.sources.places import points_of_interest
from workload import views

Query = Callable[[SparkSession, str], DataFrame]

POINT = (45.4477479, 9.1835306)
POINT_RADIUS_KM = 300.0
PAIR_RADIUS_KM = 5.0
SIGHT_RADIUS_KM = 4.0
FIXED_SIGHT_RADIUS_KM = 150.0
WORD_MIN = 100
TAG_MIN = 500

_HOTEL = ("Hotel_Name", "Reviewer_Score")
_SITE = ("Hotel_Name", "Hotel_City", "lat", "lng")


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six places, so that the order of summation does not show.

    Spelled out, since engines differ in how ``round`` treats a 5 at the end.
    """
    return df.select(
        *[
            (F.floor(F.col(field.name) * 1e6 + 0.5) / F.lit(1e6)).alias(field.name)
            if isinstance(field.dataType, T.DoubleType)
            else F.col(field.name)
            for field in df.schema.fields
        ]
    )


def toy_model(labels: dict[float, str], instruction: str = "") -> Callable[[], Callable[[pd.Series], pd.Series]]:
    """A stand-in for a classifier: the sign of the lexicon total picks its output.

    With ``instruction``, it answers nothing to a text that does not begin with it.
    """
    lexicon, marks = dict(views.LEXICON), string.punctuation

    def make():
        def score(texts):
            texts = texts.reset_index(drop=True)
            asked = texts.str.startswith(instruction)
            words = texts.str[len(instruction) :].str.lower().str.split(r"[ \t\n\x0b\f\r]+", regex=True).explode()
            totals = words.str.strip(marks).map(lexicon).fillna(0.0).groupby(level=0).sum()
            return totals.gt(0).astype(int).sub(totals.lt(0).astype(int)).map(labels).where(asked, None)

        return score

    return make


def toy_summariser():
    """A stand-in for a text model: it counts the reviews of a prompt."""

    def make():
        def answer(prompts):
            found = prompts.str.count("Positiva: ").astype(str)
            return "<think>one, two\n...</think>\n" + found + " reviews"

        return answer

    return make


# Fixed value: the instruction to the model, written out again so that a wrong one in the library shows.
INSTRUCTION = "Classify the overall sentiment of this hotel review (positive, neutral, or negative):\n"
CLASSIFIER_OUTPUT = {1: "positive", 0: "neutral", -1: "negative"}
CHAT_OUTPUT = {
    1: "The sentiment is Positive, not negative.",
    0: "I would say NEUTRAL.",
    -1: "Overall: Negative",
}


def _of_reviews(plan: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return lambda spark, sf_dir: comparable(plan(views.reviews(spark, sf_dir, *columns)))


def _of_texts(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(plan(views.text_reviews(spark, sf_dir)))


def _word_query(plan: Callable[..., DataFrame], **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        dictionary = views.lexicon(spark)
        return comparable(plan(views.text_reviews(spark, sf_dir), dictionary, WORD_MIN, **options))

    return query


def _of_raw(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(ingest.typed(views.raw_reviews(spark, sf_dir)))


def _flat(df: DataFrame) -> DataFrame:
    """Tags and date as text, for a comparison across engines."""
    return comparable(
        df.withColumn("Tags", F.array_join("Tags", "|")).withColumn(
            "Review_Date", F.col("Review_Date").cast("string")
        )
    )


def queries() -> dict[str, Query]:
    lexicon = views.LEXICON
    activity = "Total_Number_of_Reviews_Reviewer_Has_Given"
    return {
        # Cities and rankings
        "city_overview": _of_reviews(
            places.city_overview, "Hotel_City", "Hotel_Name", "Average_Score", "Reviewer_Score"
        ),
        "city_overview_of_sketches": _of_reviews(
            lambda df: places.overview_of_sketches(
                places.city_sketches(df.withColumn("year", F.year("Review_Date")), "year")
            ),
            "Hotel_City", "Hotel_Name", "Average_Score", "Reviewer_Score", "Review_Date",
        ),
        "top_hotels_by_city": _of_reviews(
            places.top_hotels_by_city, "Hotel_Nationality", "Hotel_City", *_HOTEL
        ),
        "cities_by_reviewer_nationality": _of_reviews(
            places.cities_by_reviewer_nationality, "Reviewer_Nationality", "Hotel_City", "Reviewer_Score"
        ),
        "top_hotels_one_city": _of_reviews(
            lambda df: places.top_hotels_by_city(df, city=views.ONE_CITY), "Hotel_Nationality", "Hotel_City", *_HOTEL
        ),
        "cities_one_nationality": _of_reviews(
            lambda df: places.cities_by_reviewer_nationality(df, nationality=views.ONE_CITY),
            "Reviewer_Nationality", "Hotel_City", "Reviewer_Score",
        ),
        "cities_by_known_nationality": _of_reviews(
            lambda df: places.cities_by_reviewer_nationality(df, exclude_unknown=True),
            "Reviewer_Nationality", "Hotel_City", "Reviewer_Score",
        ),
        "unique_hotels": _of_reviews(places.unique_hotels, *_SITE),
        "reviewer_nationalities": _of_reviews(
            lambda df: places.distinct_values(df, "Reviewer_Nationality"), "Reviewer_Nationality"
        ),
        "hotel_cities": _of_reviews(
            lambda df: places.distinct_values(df, "Hotel_City"), "Hotel_City"
        ),
        "hotels_of_known_cities": lambda spark, sf_dir: comparable(
            places.hotels_of_known_cities(
                views.reviews(spark, sf_dir, *_SITE), views.centres(spark, sf_dir)
            )
        ),
        # One hotel, for all hotels
        "hotel_mean_score": _of_reviews(hotels.mean_score, *_HOTEL),
        "hotel_monthly_trend": _of_reviews(hotels.monthly_trend, *_HOTEL, "Review_Date"),
        "hotel_reputation": _of_reviews(hotels.reputation, *_HOTEL, "Review_Date"),
        "anomalous_reviews": _of_reviews(
            hotels.anomalous_reviews, *_HOTEL, "Review_Date", "Positive_Review", "Negative_Review"
        ),
        "hotel_mean_score_one": _of_reviews(lambda df: hotels.mean_score(df, views.ONE_HOTEL), *_HOTEL),
        "hotel_reputation_one": _of_reviews(
            lambda df: hotels.reputation(df, hotel=views.ONE_HOTEL), *_HOTEL, "Review_Date"
        ),
        "anomalous_reviews_one": _of_reviews(
            lambda df: hotels.anomalous_reviews(df, hotel=views.ONE_HOTEL),
            *_HOTEL, "Review_Date", "Positive_Review", "Negative_Review",
        ),
        "anomalous_reviews_hot": _of_reviews(
            lambda df: hotels.anomalous_reviews(df, hot_rows=400),
            *_HOTEL, "Review_Date", "Positive_Review", "Negative_Review",
        ),
        "hotel_fact_sheet_one": _of_reviews(
            lambda df: hotels.fact_sheet(df, views.ONE_HOTEL), *_HOTEL, "lat", "lng"
        ),
        "hotel_fact_sheet": _of_reviews(hotels.fact_sheet, *_HOTEL, "lat", "lng"),
        # Distances
        "hotels_near_hotel": _of_reviews(
            lambda df: nearby.hotels_near_hotel(df, PAIR_RADIUS_KM), *_SITE
        ),
        "hotels_near_point": _of_reviews(
            lambda df: nearby.hotels_near_point(df, *POINT, POINT_RADIUS_KM), *_SITE, "Reviewer_Score"
        ),
        "hotels_near_point_by_name": _of_reviews(
            lambda df: nearby.hotels_near_point_by_name(df, *POINT, POINT_RADIUS_KM), *_SITE, "Reviewer_Score"
        ),
        "hotels_near_poi": lambda spark, sf_dir: comparable(
            nearby.hotels_near_sights(
                views.reviews(spark, sf_dir, *_SITE, "Reviewer_Score"),
                views.sights(spark, sf_dir),
                SIGHT_RADIUS_KM,
            )
        ),
        "hotels_near_fixed_sights": lambda spark, sf_dir: comparable(
            nearby.hotels_near_sights(
                views.reviews(spark, sf_dir, *_SITE, "Reviewer_Score"), points_of_interest(spark), FIXED_SIGHT_RADIUS_KM
            )
        ),
        # Words, tags, lengths
        "word_scores_benchmark": lambda spark, sf_dir: comparable(
            words.word_scores(
                views.text_reviews(spark, sf_dir), views.benchmark_dictionary(spark, sf_dir), WORD_MIN
            )
        ),
        "word_scores": _word_query(words.word_scores),
        "word_scores_positive": _word_query(words.positive_word_scores),
        "word_scores_negative": _word_query(words.negative_word_scores),
        "word_scores_bare": _word_query(words.word_scores, bare_words=True, exclude_imputed=True),
        "tag_frequency": _of_reviews(words.tag_frequency, "Tags"),
        "tags_top10": _of_reviews(words.most_used_tags, "Tags"),
        "tags_bottom10": _of_reviews(words.least_used_tags, "Tags"),
        "tag_influence": _of_reviews(
            lambda df: words.tag_influence(df, TAG_MIN), "Tags", "Reviewer_Score"
        ),
        "review_length_extremes": _of_texts(words.review_length_extremes),
        "review_length_extremes_by_hotel": _of_texts(
            lambda df: words.review_length_extremes(df, by="Hotel_Name", id_column="review_id")
        ),
        # Sentiment
        "sentiment_by_season": _of_texts(lambda df: seasons.sentiment_by_season(df, lexicon)),
        "sentiment_by_season_lexicon_table": lambda spark, sf_dir: comparable(
            seasons.sentiment_by_season(
                views.text_reviews(spark, sf_dir), views.untidy_lexicon(spark), id_column="review_id"
            )
        ),
        "sentiment_by_hotel_season": _of_texts(
            lambda df: seasons.sentiment_by_hotel_season(df, lexicon)
        ),
        "sentiment_by_nation_season": _of_texts(
            lambda df: seasons.sentiment_by_nation_season(df, lexicon)
        ),
        "sentiment_one_nation": _of_texts(
            lambda df: seasons.sentiment_by_nation_season(df, lexicon, views.ONE_NATION)
        ),
        "best_worst_season_by_nation": _of_texts(
            lambda df: seasons.best_and_worst_season(df, lexicon)
        ),
        "sentiment_by_nation": _of_texts(lambda df: seasons.sentiment_by_nation(df, lexicon)),
        "sentiment_map": lambda spark, sf_dir: comparable(
            seasons.sentiment_map(
                views.text_reviews(spark, sf_dir), views.outlines(spark, sf_dir), lexicon
            )
        ),
        "classified_sentiment": _of_texts(
            lambda df: classified.hotel_sentiment(df, classified.lexicon_label(lexicon))
        ),
        "classified_sentiment_lexicon_table": lambda spark, sf_dir: comparable(
            classified.hotel_sentiment(
                *classified.with_lexicon_label(
                    views.text_reviews(spark, sf_dir), views.untidy_lexicon(spark), "review_id"
                )
            )
        ),
        "classified_sentiment_model": _of_texts(
            lambda df: classified.hotel_sentiment(
                df, classified.model_label(toy_model(CLASSIFIER_OUTPUT))
            )
        ),
        "seasonal_label_stats": _of_texts(
            lambda df: classified.seasonal_label_stats(
                df,
                toy_model(CHAT_OUTPUT, INSTRUCTION),
                per_season=5,
                order=("Review_Date", "review_id"),
                id_column="review_id",
            )
        ),
        "seasonal_label_stats_hot": _of_texts(
            lambda df: classified.seasonal_label_stats(
                df,
                toy_model(CHAT_OUTPUT, INSTRUCTION),
                per_season=5,
                order=("Review_Date", "review_id"),
                hot_rows=1,
                id_column="review_id",
            )
        ),
        # Digests
        "review_digest": _of_texts(lambda df: digest.review_digest(df, id_column="review_id")),
        "review_digest_hot": _of_texts(lambda df: digest.review_digest(df, hot_rows=9, id_column="review_id")),
        "hotel_summaries": _of_texts(
            lambda df: digest.hotel_summaries(digest.review_digest(df), toy_summariser())
        ),
        "model_output_text": lambda spark, sf_dir: views.table(
            spark, sf_dir, "conversations"
        ).select(
            "conv_id",
            "turn",
            strip_reasoning(
                F.concat(F.lit(" <think>about "), "role", F.lit("\n</think>\n"), "text", F.lit("<think></think> "))
            ).alias("answer"),
        ),
        # Ingest and data quality
        "clean_reviews": _of_raw(lambda df: _flat(ingest.clean(df))),
        "null_profile": _of_raw(quality.null_profile),
        "non_null_counts": _of_raw(quality.non_null_counts),
        "table_info": _of_raw(quality.table_info),
        "rows_with_blanks": _of_raw(lambda df: _flat(quality.rows_with_blanks(df))),
    }
