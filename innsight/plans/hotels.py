"""One hotel looked at closely, for all hotels at once."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.functions.bands import reputation_trend, score_band
from innsight.functions.dates import year_month
from innsight.operators.skew import HOT_ROWS, spread_join
from innsight.plans.common import only, sorted_if

# Fixed value. In the fact sheet a score of exactly 6 is a good one.
GOOD_SCORE = 6


def mean_score(reviews: DataFrame, hotel: str | None = None) -> DataFrame:
    """Mean score over all time and its band."""
    return (
        only(reviews, "Hotel_Name", hotel)
        .groupBy("Hotel_Name")
        .agg(F.round(F.avg("Reviewer_Score"), 1).alias("avg_score"))
        .withColumn("band", score_band(F.col("avg_score")))
    )


def monthly_trend(reviews: DataFrame, hotel: str | None = None) -> DataFrame:
    date = F.col("Review_Date")
    trend = (
        only(reviews, "Hotel_Name", hotel)
        .groupBy(
            "Hotel_Name",
            F.year(date).alias("anno"),
            F.month(date).alias("mese"),
            year_month(date).alias("periodo"),
        )
        .agg(F.round(F.avg("Reviewer_Score"), 1).alias("media_mensile"))
    )
    return sorted_if(trend, hotel, "anno", "mese")


def reputation(
    reviews: DataFrame, days: int = 30, hotel: str | None = None, as_of: datetime.date | None = None
) -> DataFrame:
    """Mean of the last ``days`` days against the mean over all time.

    The days count back from ``as_of`` or else from the latest review of the whole
    table, which is then read for its dates too; of a stored table
    :func:`innsight.sources.reviews.latest_date` gives it without. A hotel without a
    recent review has no recent mean and no difference.
    """
    latest = reviews.agg(F.max("Review_Date").alias("latest")).scalar() if as_of is None else F.lit(as_of)
    recent = F.datediff(latest, F.col("Review_Date")) <= days
    return (
        only(reviews, "Hotel_Name", hotel)
        .groupBy("Hotel_Name")
        .agg(
            F.avg("Reviewer_Score").alias("media_storica"),
            F.avg(F.when(recent, F.col("Reviewer_Score"))).alias("media_ultimi_30gg"),
        )
        .withColumn("reputazione", F.col("media_ultimi_30gg") - F.col("media_storica"))
        .withColumn("andamento", reputation_trend(F.col("reputazione")))
    )


def anomalous_reviews(
    reviews: DataFrame,
    k: float = 2.0,
    hotel: str | None = None,
    spread_by: tuple[str, ...] = ("Review_Date",),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Reviews whose score is more than ``k`` sample deviations off their hotel's mean.

    A hotel with much of the data is spread over several tasks by ``spread_by``
    and the texts.
    """
    chosen = only(reviews, "Hotel_Name", hotel)
    stats = chosen.groupBy("Hotel_Name").agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg("Reviewer_Score").alias("avg_score"),
        F.stddev_samp("Reviewer_Score").alias("stddev_score"),
    )
    texts = ["Positive_Review", "Negative_Review"]
    columns = list(dict.fromkeys(["Hotel_Name", "Reviewer_Score", *texts, *spread_by]))
    off = F.abs(F.col("Reviewer_Score") - F.col("avg_score"))
    found = (
        spread_join(chosen.select(*columns), stats, "Hotel_Name", "_n", columns, hot_rows)
        .filter(off > k * F.col("stddev_score"))
        .select("Hotel_Name", "Reviewer_Score", "avg_score", "stddev_score", *texts)
    )
    return sorted_if(found, hotel, "Reviewer_Score", *texts)


def fact_sheet(reviews: DataFrame, hotel: str | None = None) -> DataFrame:
    """Counts, scores and place of each hotel.

    The place is that of one of its sites, the least by (lat, lng); a site without
    both coordinates counts only if there is no other.
    """
    score = F.col("Reviewer_Score")
    sites = (
        only(reviews, "Hotel_Name", hotel)
        .groupBy("Hotel_Name", "lat", "lng")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count_if(score >= GOOD_SCORE).alias("_good"),
            F.count_if(score < GOOD_SCORE).alias("_bad"),
            F.max(score).alias("_max"),
            F.min(score).alias("_min"),
            F.sum(score).alias("_sum"),
            F.count(score).alias("_scored"),
        )
    )
    place = F.min(F.struct(F.col("lat").isNull() | F.col("lng").isNull(), "lat", "lng"))
    return (
        sites.groupBy("Hotel_Name")
        .agg(
            F.sum("_n").alias("Total_Reviews"),
            F.sum("_good").alias("Total_Positive_Reviews"),
            F.sum("_bad").alias("Total_Negative_Reviews"),
            F.max("_max").alias("Max_Reviewer_Score"),
            F.min("_min").alias("Min_Reviewer_Score"),
            F.try_divide(F.sum("_sum"), F.sum("_scored")).alias("Avg_Reviewer_Score"),
            place.alias("_place"),
        )
        .select("*", F.col("_place.lat").alias("Latitude"), F.col("_place.lng").alias("Longitude"))
        .drop("_place")
    )
