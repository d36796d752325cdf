"""Cities and hotels compared: overview, rankings, preferences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.operators.distinct import LG_K, distinct_sketch, estimate, merge_sketches
from innsight.operators.skew import top_n
from innsight.plans.common import only
from innsight.schema import IMPUTED

# Fixed value. In the city overview a score of exactly 6 is on neither side.
NEUTRAL_SCORE = 6


def city_overview(reviews: DataFrame) -> DataFrame:
    """Reviews, hotels, mean of the hotel score over reviews, bad and good reviews per city."""
    score = F.col("Reviewer_Score")
    return reviews.groupBy("Hotel_City").agg(
        F.count(F.lit(1)).alias("Total_Reviews"),
        F.count_distinct("Hotel_Name").alias("Number_Hotel"),
        F.round(F.avg("Average_Score"), 2).alias("Average_Score"),
        F.count_if(score < NEUTRAL_SCORE).alias("TotalN"),
        F.count_if(score > NEUTRAL_SCORE).alias("TotalP"),
    )


def city_sketches(reviews: DataFrame, *parts: str, lg_k: int = LG_K) -> DataFrame:
    """Per city and ``parts`` (days, files) what :func:`overview_of_sketches` needs: sums, counts and a sketch of the hotels.

    To be stored: new reviews add rows, old ones are not read again.
    """
    score = F.col("Reviewer_Score")
    return reviews.groupBy("Hotel_City", *parts).agg(
        F.count(F.lit(1)).alias("reviews"),
        distinct_sketch("Hotel_Name", lg_k).alias("hotels"),
        F.sum("Average_Score").alias("score_sum"),
        F.count("Average_Score").alias("scored"),
        F.count_if(score < NEUTRAL_SCORE).alias("bad"),
        F.count_if(score > NEUTRAL_SCORE).alias("good"),
    )


def overview_of_sketches(sketches: DataFrame) -> DataFrame:
    """:func:`city_overview` from the rows of :func:`city_sketches`, the number of hotels estimated."""
    summed = sketches.groupBy("Hotel_City").agg(
        F.sum("reviews").alias("Total_Reviews"),
        F.round(F.try_divide(F.sum("score_sum"), F.sum("scored")), 2).alias("Average_Score"),
        F.sum("bad").alias("TotalN"),
        F.sum("good").alias("TotalP"),
    )
    hotels = merge_sketches(sketches, "hotels", "Hotel_City").select(
        F.col("Hotel_City").alias("_city"), estimate("hotels").alias("Number_Hotel")
    )
    return summed.join(hotels, F.col("Hotel_City").eqNullSafe(F.col("_city"))).select(
        "Hotel_City", "Total_Reviews", "Number_Hotel", "Average_Score", "TotalN", "TotalP"
    )


def top_hotels_by_city(reviews: DataFrame, n: int = 5, city: str | None = None) -> DataFrame:
    """The ``n`` best hotels of each city beside the mean over its reviews.

    Hotels whose city is not known are left out.

    Reviews are summed up per hotel once; the city means are made from those
    sums, so the table is read and shuffled a single time.
    """
    place = ["Hotel_Nationality", "Hotel_City"]
    hotels = (
        only(reviews, "Hotel_City", city)
        .groupBy(*place, "Hotel_Name")
        .agg(F.sum("Reviewer_Score").alias("_sum"), F.count("Reviewer_Score").alias("_n"))
    )
    cities = hotels.groupBy(*place).agg(
        (F.sum("_sum") / F.sum("_n")).alias("city_avg_score")
    )
    best = top_n(
        hotels.withColumn("avg_score", F.round(F.col("_sum") / F.col("_n"), 3)),
        place,
        [F.desc("avg_score"), F.asc("Hotel_Name")],
        n,
    )
    return (
        best.join(cities, place)
        .select(*place, "city_avg_score", "Hotel_Name", "avg_score", "rank")
        .orderBy("Hotel_Nationality", "Hotel_City", "rank")
    )


def cities_by_reviewer_nationality(
    reviews: DataFrame,
    top: int = 10,
    nationality: str | None = None,
    exclude_unknown: bool = False,
) -> DataFrame:
    """The cities each nationality scores highest."""
    chosen = only(reviews, "Reviewer_Nationality", nationality)
    if exclude_unknown:
        chosen = chosen.filter(F.col("Reviewer_Nationality") != IMPUTED["Reviewer_Nationality"])
    scored = chosen.groupBy("Reviewer_Nationality", "Hotel_City").agg(
        F.avg("Reviewer_Score").alias("avg_score")
    )
    best = top_n(scored, ["Reviewer_Nationality"], [F.desc("avg_score"), F.asc("Hotel_City")], top)
    return best.orderBy("Reviewer_Nationality", "rank")


def unique_hotels(reviews: DataFrame) -> DataFrame:
    return reviews.select("Hotel_Name", "Hotel_City", "lat", "lng").distinct()


def distinct_values(reviews: DataFrame, column: str, exclude_unknown: bool | None = None) -> DataFrame:
    """Sorted values of a column, for a choice list.

    The imputed nationality is left out of the nationalities unless asked for.
    """
    if exclude_unknown is None:
        exclude_unknown = column == "Reviewer_Nationality"
    values = reviews.select(column).filter(F.col(column).isNotNull()).distinct()
    if exclude_unknown:
        values = values.filter(F.col(column) != IMPUTED["Reviewer_Nationality"])
    return values.orderBy(column)


def hotels_of_known_cities(reviews: DataFrame, centres: DataFrame) -> DataFrame:
    """Hotels lying in one of the listed cities, with the city's centre.

    ``centres`` has ``city``, ``alias``, ``lat``, ``lng``; a hotel's city may be
    written either way.
    """
    spelled = centres.select(
        F.col("city"),
        F.explode(F.array_distinct(F.array("city", "alias"))).alias("Hotel_City"),
        F.col("lat").alias("centre_lat"),
        F.col("lng").alias("centre_lng"),
    )
    return unique_hotels(reviews).join(spelled, "Hotel_City").select(
        "Hotel_Name", "Hotel_City", "lat", "lng", "city", "centre_lat", "centre_lng"
    )
