"""All questions on one cleaned review table, as methods of one object."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from innsight.operators.scoring import Scorer
from innsight.operators.sentiment import Lexicon
from innsight.plans import classified, digest, hotels, ingest, nearby, places, quality, seasons, words
from innsight.sources import reviews as source


class HotelReviews:
    """Cleaned reviews, with the dictionaries some questions need.

    ``lexicon``: word valences, as a mapping or as a table (``word``,
    ``valence``) together with ``review_id``, a unique key of the reviews.
    ``dictionary``: a table (``word``, ``pos``) of parts of speech.
    """

    def __init__(
        self,
        reviews: DataFrame,
        lexicon: Lexicon | None = None,
        dictionary: DataFrame | None = None,
        review_id: str | None = None,
    ) -> None:
        self.reviews = reviews
        self._lexicon = lexicon
        self._dictionary = dictionary
        self.review_id = review_id

    @property
    def lexicon(self) -> Lexicon:
        if self._lexicon is None:
            raise ValueError("this question needs a lexicon")
        return self._lexicon

    @property
    def dictionary(self) -> DataFrame:
        if self._dictionary is None:
            raise ValueError("this question needs a dictionary of parts of speech")
        return self._dictionary

    @classmethod
    def from_csv(cls, spark: SparkSession, path: str, with_id: bool = False, **given) -> HotelReviews:
        """Read, type and clean raw files. For more than a few questions store
        the result with :func:`innsight.sources.reviews.write_clean` first."""
        cleaned = ingest.clean(ingest.typed(source.read_raw(spark, path)), with_id)
        return cls(cleaned, review_id=ingest.REVIEW_ID if with_id else None, **given)

    # Cities and rankings

    def city_overview(self) -> DataFrame:
        return places.city_overview(self.reviews)

    def city_sketches(self, *parts: str) -> DataFrame:
        """What the overview needs per city and part, to be stored and merged by ``places.overview_of_sketches``."""
        return places.city_sketches(self.reviews, *parts)

    def top_hotels(self, city: str | None = None, n: int = 5) -> DataFrame:
        return places.top_hotels_by_city(self.reviews, n, city)

    def favourite_cities(
        self, nationality: str | None = None, top: int = 10, exclude_unknown: bool = False
    ) -> DataFrame:
        return places.cities_by_reviewer_nationality(self.reviews, top, nationality, exclude_unknown)

    def unique_hotels(self) -> DataFrame:
        return places.unique_hotels(self.reviews)

    def distinct_values(self, column: str, exclude_unknown: bool | None = None) -> DataFrame:
        return places.distinct_values(self.reviews, column, exclude_unknown)

    def hotels_of_known_cities(self, centres: DataFrame) -> DataFrame:
        return places.hotels_of_known_cities(self.reviews, centres)

    # Words, tags, lengths

    def word_scores(
        self, min_frequency: int = words.MIN_COUNT, n: int | None = None
    ) -> tuple[DataFrame, DataFrame]:
        """Words of positive texts, best first, and of negative texts, worst first; the first ``n`` of each."""
        return (
            words.positive_word_scores(self.reviews, self.dictionary, min_frequency, n),
            words.negative_word_scores(self.reviews, self.dictionary, min_frequency, n),
        )

    def tag_frequency(self) -> DataFrame:
        return words.tag_frequency(self.reviews)

    def most_used_tags(self, n: int = 10) -> DataFrame:
        return words.most_used_tags(self.reviews, n)

    def least_used_tags(self, n: int = 10) -> DataFrame:
        return words.least_used_tags(self.reviews, n)

    def tag_influence(self, min_count: int = words.MIN_COUNT) -> DataFrame:
        return words.tag_influence(self.reviews, min_count)

    def length_extremes(self, by: str | None = None) -> DataFrame:
        return words.review_length_extremes(self.reviews, by, self.review_id)

    # Sentiment

    def sentiment_by_season(self) -> DataFrame:
        return seasons.sentiment_by_season(self.reviews, self.lexicon, self.review_id)

    def sentiment_by_hotel_season(self, hotel: str | None = None) -> DataFrame:
        return seasons.sentiment_by_hotel_season(self.reviews, self.lexicon, hotel, self.review_id)

    def sentiment_by_nation_season(self, nation: str | None = None) -> DataFrame:
        return seasons.sentiment_by_nation_season(self.reviews, self.lexicon, nation, self.review_id)

    def best_and_worst_season(self, nation: str | None = None) -> DataFrame:
        return seasons.best_and_worst_season(self.reviews, self.lexicon, nation, self.review_id)

    def sentiment_by_nation(self) -> DataFrame:
        return seasons.sentiment_by_nation(self.reviews, self.lexicon, self.review_id)

    def sentiment_map(self, outlines: DataFrame) -> DataFrame:
        return seasons.sentiment_map(self.reviews, outlines, self.lexicon, self.review_id)

    def classified_sentiment(
        self, hotel: str | None = None, make_model: Callable[[], Scorer] | None = None
    ) -> DataFrame:
        """Labels of a model, or of the lexicon where no model is given."""
        if make_model is not None:
            return classified.hotel_sentiment(self.reviews, classified.model_label(make_model), hotel)
        labelled = classified.with_lexicon_label(self.reviews, self.lexicon, self.review_id)
        return classified.hotel_sentiment(*labelled, hotel)

    def seasonal_label_stats(
        self, make_model: Callable[[], Scorer], hotel: str | None = None, per_season: int = 1
    ) -> DataFrame:
        return classified.seasonal_label_stats(self.reviews, make_model, per_season, hotel, id_column=self.review_id)

    # One hotel

    def mean_score(self, hotel: str | None = None) -> DataFrame:
        return hotels.mean_score(self.reviews, hotel)

    def monthly_trend(self, hotel: str | None = None) -> DataFrame:
        return hotels.monthly_trend(self.reviews, hotel)

    def hotels_near_hotel(self, hotel: str | None = None, radius_km: float = 1.0) -> DataFrame:
        return nearby.hotels_near_hotel(self.reviews, radius_km, hotel)

    def hotels_near_point(self, lat: float, lng: float, radius_km: float = 500.0) -> DataFrame:
        return nearby.hotels_near_point(self.reviews, lat, lng, radius_km)

    def hotels_near_sights(self, sights: DataFrame, radius_km: float = 1.0) -> DataFrame:
        return nearby.hotels_near_sights(self.reviews, sights, radius_km)

    def reputation(
        self, hotel: str | None = None, days: int = 30, as_of: datetime.date | None = None
    ) -> DataFrame:
        return hotels.reputation(self.reviews, days, hotel, as_of)

    def anomalous_reviews(self, hotel: str | None = None, k: float = 2.0) -> DataFrame:
        return hotels.anomalous_reviews(self.reviews, k, hotel)

    def fact_sheet(self, hotel: str | None = None) -> DataFrame:
        return hotels.fact_sheet(self.reviews, hotel)

    def review_digest(self, hotel: str | None = None, limit: int = digest.REVIEWS_PER_DIGEST) -> DataFrame:
        return digest.review_digest(self.reviews, limit, hotel, id_column=self.review_id)

    def summaries(
        self,
        make_model: Callable[[], Scorer],
        hotel: str | None = None,
        limit: int = digest.REVIEWS_PER_DIGEST,
    ) -> DataFrame:
        return digest.hotel_summaries(self.review_digest(hotel, limit), make_model)

    # Data quality

    def null_profile(self) -> DataFrame:
        return quality.null_profile(self.reviews)

    def non_null_counts(self) -> DataFrame:
        return quality.non_null_counts(self.reviews)

    def rows_with_blanks(self) -> DataFrame:
        return quality.rows_with_blanks(self.reviews)

    def info(self) -> DataFrame:
        return quality.table_info(self.reviews)

    def peek(self, rows: int = 20) -> None:
        quality.peek(self.reviews, rows)
