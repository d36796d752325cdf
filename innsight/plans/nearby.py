"""Hotels near a hotel, a point or a list of sights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innsight.operators.late import only_ids
from innsight.operators.radius import near_point, pairs_within
from innsight.plans.common import only, sorted_if
from innsight.plans.places import unique_hotels


def hotels_near_hotel(
    reviews: DataFrame, radius_km: float = 1.0, hotel: str | None = None
) -> DataFrame:
    """Other hotels within ``radius_km`` of each site (``lat``, ``lng``) of each hotel.

    A hotel is never its own neighbour, at any of its sites. A hotel that is
    not in the table has no rows. Each pair is given from both its ends, so a
    radius as wide as the data gives all pairs of sites.
    """
    origins = only(unique_hotels(reviews), "Hotel_Name", hotel).select(
        "Hotel_Name", F.col("lat").alias("_lat"), F.col("lng").alias("_lng")
    ).distinct()
    others = unique_hotels(reviews).select(
        F.col("Hotel_Name").alias("Nearby_Hotel"), F.col("Hotel_City").alias("Nearby_City"), "lat", "lng"
    )
    pairs = (
        pairs_within(origins, others, radius_km, ("_lat", "_lng"), ("lat", "lng"))
        .filter(F.col("Hotel_Name") != F.col("Nearby_Hotel"))
        .select(
            "Hotel_Name", F.col("_lat").alias("lat"), F.col("_lng").alias("lng"),
            "Nearby_Hotel", "Nearby_City", "distanza",
        )
    )
    return sorted_if(pairs, hotel, "distanza", "Nearby_Hotel")


def _sites_with_means(reviews: DataFrame) -> DataFrame:
    """Each site once, with the mean score of all sites of its name: one pass over the reviews."""
    sites = reviews.groupBy("Hotel_Name", "Hotel_City", "lat", "lng").agg(
        F.sum("Reviewer_Score").alias("_sum"), F.count("Reviewer_Score").alias("_n")
    )
    name = Window.partitionBy("Hotel_Name")
    mean = F.try_divide(F.sum("_sum").over(name), F.sum("_n").over(name))
    return sites.withColumn("Avg_Score", mean).drop("_sum", "_n")


def hotels_near_point(
    reviews: DataFrame, lat: float, lng: float, radius_km: float = 500.0
) -> DataFrame:
    """Hotel sites within ``radius_km`` of a point, nearest first, with the mean score of the name."""
    return (
        near_point(_sites_with_means(reviews), lat, lng, radius_km)
        .select("Hotel_Name", "Hotel_City", "lat", "lng", "distanza", "Avg_Score")
        .orderBy("distanza", "Hotel_Name")
    )


def hotels_near_point_by_name(
    reviews: DataFrame, lat: float, lng: float, radius_km: float = 500.0
) -> DataFrame:
    """:func:`hotels_near_point` in two readings, for a circle that holds little of a large table.

    The first reads sites alone, in the ranges of latitude and longitude that the scan
    skips data by; the second the scores of the names found, which are not shuffled
    for any others.
    """
    sites = near_point(reviews.select("Hotel_Name", "Hotel_City", "lat", "lng"), lat, lng, radius_km).distinct()
    names = sites.select("Hotel_Name").distinct()
    scores = only_ids(reviews.select("Hotel_Name", "Reviewer_Score"), names, "Hotel_Name")
    means = scores.groupBy(F.col("Hotel_Name").alias("_name")).agg(F.avg("Reviewer_Score").alias("Avg_Score"))
    return (
        sites.join(means, F.col("Hotel_Name").eqNullSafe(F.col("_name")))
        .select("Hotel_Name", "Hotel_City", "lat", "lng", "distanza", "Avg_Score")
        .orderBy("distanza", "Hotel_Name")
    )


def hotels_near_sights(reviews: DataFrame, sights: DataFrame, radius_km: float = 1.0) -> DataFrame:
    """:func:`hotels_near_point` for every row of ``sights`` (``nome``, ``lat``, ``lng``) in one job."""
    points = sights.select(
        F.col("nome").alias("poi"), F.col("lat").alias("_lat"), F.col("lng").alias("_lng")
    )
    near = pairs_within(points, _sites_with_means(reviews), radius_km, ("_lat", "_lng"), ("lat", "lng"))
    return near.select(
        "poi", "Hotel_Name", "Hotel_City", "lat", "lng", "distanza", "Avg_Score"
    )
