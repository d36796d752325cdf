"""Radius join against all pairs taken by brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from innsight.operators.radius import near_point, pairs_within
from innsight.plans import nearby
from innsight.sources import places as place_tables


def km(lat0, lng0, lat1, lng1):
    a = (
        math.sin(math.radians(lat1 - lat0) / 2) ** 2
        + math.cos(math.radians(lat0)) * math.cos(math.radians(lat1)) * math.sin(math.radians(lng1 - lng0) / 2) ** 2
    )
    return 2 * 6371 * math.asin(min(1, math.sqrt(a)))


def somewhere(seed, middle_lat, middle_lng, spread, n):
    rnd = random.Random(seed)
    points = []
    for _ in range(n):
        lat = max(-90.0, min(90.0, middle_lat + rnd.uniform(-spread, spread)))
        lng = middle_lng + rnd.uniform(-4 * spread, 4 * spread)
        points.append((lat, (lng + 180) % 360 - 180))
    return points


@pytest.mark.parametrize(
    ("middle_lat", "middle_lng", "spread", "radius"),
    [
        (45.0, 9.0, 0.05, 1.0),
        (52.0, 4.9, 1.0, 25.0),
        (0.0, 180.0, 0.5, 40.0),
        (-17.0, -180.0, 0.2, 10.0),
        (89.9, 0.0, 45.0, 700.0),
        (-89.99, 30.0, 0.02, 1.5),
        (70.0, 179.9, 2.0, 120.0),
        (10.0, 20.0, 60.0, 6000.0),
        (0.0, 0.0, 80.0, 15000.0),
        (0.0, 0.0, 80.0, 25000.0),
    ],
)
def test_pairs(spark, middle_lat, middle_lng, spread, radius):
    points = somewhere(7, middle_lat, middle_lng, spread, 120)
    points += [(middle_lat, middle_lng), (middle_lat, -180.0), (90.0, 0.0), (-90.0, 11.0)]
    left = spark.createDataFrame(
        [(i, *p) for i, p in enumerate(points)], "a int, lat0 double, lng0 double"
    )
    right = spark.createDataFrame(
        [(i, *p) for i, p in enumerate(points)], "b int, lat1 double, lng1 double"
    )
    found = pairs_within(left, right, radius, ("lat0", "lng0"), ("lat1", "lng1"))
    rows = [(row.a, row.b) for row in found.collect()]
    assert len(rows) == len(set(rows))
    # Pairs on the rim may fall either way by rounding.
    distances = {(i, j): km(*p, *q) for i, p in enumerate(points) for j, q in enumerate(points)}
    assert set(rows) <= {pair for pair, d in distances.items() if d <= radius + 1e-6}
    assert set(rows) >= {pair for pair, d in distances.items() if d <= radius - 1e-6}


@pytest.mark.parametrize(
    ("lat", "lng", "radius"),
    [(45.0, 9.0, 100.0), (0.0, 179.9, 300.0), (89.0, 0.0, 500.0), (-60.0, -179.0, 2000.0), (10.0, 10.0, 25000.0)],
)
def test_near_point(spark, lat, lng, radius):
    points = somewhere(3, lat, lng, 10.0, 400)
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, lat double, lng double")
    found = {row.i: row.distanza for row in near_point(df, lat, lng, radius).collect()}
    expected = {i: km(lat, lng, *p) for i, p in enumerate(points) if km(lat, lng, *p) <= radius}
    assert found.keys() == expected.keys()
    assert all(found[i] == pytest.approx(expected[i], abs=1e-6) for i in found)


def test_neighbours_of_one_hotel(spark):
    rows = [
        ("A", "Milan", 45.0, 9.0, 8.0),
        ("A", "Milan", 45.0, 9.0, 6.0),
        ("A", "Milan", 45.001, 9.0, 6.0),
        ("B", "Milan", 45.005, 9.0, 9.0),
        ("C", "Milan", 46.0, 9.0, 9.0),
    ]
    reviews = spark.createDataFrame(
        rows, "Hotel_Name string, Hotel_City string, lat double, lng double, Reviewer_Score double"
    )
    found = nearby.hotels_near_hotel(reviews, 1.0, hotel="A").collect()
    assert [row.Nearby_Hotel for row in found] == ["B", "B"]  # once per site of A
    assert nearby.hotels_near_hotel(reviews, 1.0, hotel="nobody").count() == 0
    assert nearby.hotels_near_hotel(reviews, 1.0).count() == 4
    near = nearby.hotels_near_point(reviews, 45.0, 9.0, 1.0).collect()
    assert [(row.Hotel_Name, row.Avg_Score) for row in near] == [("A", 20 / 3), ("A", 20 / 3), ("B", 9.0)]


def test_sights(spark):
    sights = place_tables.points_of_interest(spark)
    assert sights.count() == 42
    assert place_tables.city_centres(spark).count() == 6
    assert place_tables.nations(spark).count() == 6
    reviews = spark.createDataFrame(
        [("H", "Milan", 45.4642, 9.1916, 8.0)],
        "Hotel_Name string, Hotel_City string, lat double, lng double, Reviewer_Score double",
    )
    near = {row.poi: row.distanza for row in nearby.hotels_near_sights(reviews, sights, 0.5).collect()}
    assert near["Duomo di Milano"] == 0.0
    assert set(near) == {"Duomo di Milano", "Galleria Vittorio Emanuele II", "Teatro alla Scala"}


def test_outline_names(spark, tmp_path):
    path = tmp_path / "outlines.geojson"
    path.write_text(
        '{"type": "FeatureCollection",\n "features": [\n'
        '{"type": "Feature", "properties": {"name": "Italy", "x": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}},\n'
        '{"type": "Feature", "properties": {"name": "Norway"}, "geometry": null}]}'
    )
    assert [row.name for row in place_tables.outline_names(spark, str(path)).collect()] == ["Italy"]
    assert place_tables.outline_names(spark, str(path), ["Norway"]).count() == 1


def test_crowded_cell_is_split_at_run_time(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        # Two points in three lie in one cell, the rest all over the world.
        reviews = spark.range(0, 3000, 1, 16).selectExpr(
            "concat('H', id) as Hotel_Name",
            "'City' as Hotel_City",
            "if(id % 3 > 0, 45D + id / 1e7, (id % 170) - 85D) as lat",
            "if(id % 3 > 0, 9D, (id % 357) - 178D) as lng",
        )
        pairs = nearby.hotels_near_hotel(reviews, 1.0)
        assert pairs.count() == 2000 * 1999
        found = pairs.selectExpr("count(*)")
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)


CASES = [
    (45.0, 9.0, 0.05, 1.0), (52.0, 4.9, 1.0, 25.0), (0.0, 180.0, 0.5, 40.0), (-17.0, -180.0, 0.2, 10.0),
    (89.9, 0.0, 45.0, 700.0), (-89.99, 30.0, 0.02, 1.5), (70.0, 179.9, 2.0, 120.0), (10.0, 20.0, 60.0, 6000.0),
    (0.0, 0.0, 80.0, 15000.0),
]


def points_of(spark, points, name, n):
    return spark.createDataFrame([(i, *p) for i, p in enumerate(points)], f"{name} int, lat{n} double, lng{n} double")


@pytest.mark.parametrize("cell_rows", [1, 5])
@pytest.mark.parametrize("case", CASES)
def test_divided_cells_have_the_same_pairs(spark, case, cell_rows):
    middle_lat, middle_lng, spread, radius = case
    points = somewhere(8, middle_lat, middle_lng, spread, 70) + [(middle_lat, middle_lng), (90.0, 0.0), (-90.0, 11.0)]
    left, right = points_of(spark, points, "a", 0), points_of(spark, points, "b", 1)
    found = pairs_within(left, right, radius, ("lat0", "lng0"), ("lat1", "lng1"), cell_rows=cell_rows)
    plain = pairs_within(left, right, radius, ("lat0", "lng0"), ("lat1", "lng1"), cell_rows=10**6)
    rows = sorted(map(tuple, found.collect()))
    assert rows == sorted(map(tuple, plain.collect())) and len(rows) == len(set(rows))


def test_most_points_in_one_cell(spark):
    """Nine tenths of the points within a kilometre, some of them at one place."""
    crowd = somewhere(1, 45.0, 9.0, 0.002, 500) + [(45.0, 9.0)] * 40
    points = crowd + somewhere(2, 45.0, 9.0, 0.5, 60)
    left, right = points_of(spark, points, "a", 0), points_of(spark, points, "b", 1)
    left = left.union(spark.createDataFrame([(9999, None, 9.0)], left.schema))
    found = pairs_within(left, right, 0.2, ("lat0", "lng0"), ("lat1", "lng1"), cell_rows=20)
    rows = {(row.a, row.b) for row in found.collect()}
    distances = {(i, j): km(*p, *q) for i, p in enumerate(points) for j, q in enumerate(points)}
    assert rows <= {pair for pair, d in distances.items() if d <= 0.2 + 1e-9}
    assert rows >= {pair for pair, d in distances.items() if d <= 0.2 - 1e-9}


def test_a_crowded_cell_is_dealt_to_many_tasks(spark):
    points = somewhere(1, 45.0, 9.0, 0.001, 3000)
    left, right = points_of(spark, points, "a", 0), points_of(spark, points, "b", 1)
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in held}
    for name, value in held.items():
        spark.conf.set(name, value)
    try:
        pairs = pairs_within(left, right, 0.5, ("lat0", "lng0"), ("lat1", "lng1"), cell_rows=100)
        sizes = [row["count"] for row in pairs.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(sizes) == 16 and max(sizes) < sum(sizes) / 4
