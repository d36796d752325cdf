"""Pairs of points within a radius, as an equi-join on grid cells.

The sphere is cut into bands of latitude, one radius high, and every band into
cells at least one radius wide at its narrowest place. Each point of the right
side sits in one cell; each point of the left side is put into every cell that
its circle may touch (three by three at most, all around next to a pole). The
join on (band, cell) is therefore exact: it holds across the 180th meridian and
over the poles, and no distance is computed for far-away pairs. Two points in
one cell are at most a small multiple of the radius apart, so the candidates
stay within a constant factor of the result.

A cell crowded with points divides itself: it is cut into quarters, these into
quarters again, as often as its count asks for, and a point of the left side goes
to those pieces alone that its circle may touch. Where the left side is the crowded
one its points are dealt out, and the right ones repeated for each part. Few cells
can be crowded, so their list is broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.functions.geo import EARTH_RADIUS_KM, haversine_km

#: A cell of more points is crowded; at most rows / CELL_ROWS cells are.
CELL_ROWS = 20_000
#: Most times a cell is quartered: a billion pieces. Points at one place can't be told apart by more.
MOST_DEPTH = 15


class _Grid:
    def __init__(self, radius_km: float):
        # A hair more than the radius, so that rounding loses no pair on the rim.
        self.step = max(math.degrees(radius_km / EARTH_RADIUS_KM) * (1 + 1e-9), 1e-6)
        self.last_band = int(180 // self.step)

    def band(self, lat: Column) -> Column:
        return F.least(F.floor((lat + 90) / self.step), F.lit(self.last_band)).cast("int")

    def cells_in(self, band: Column) -> Column:
        farthest = F.greatest(
            F.abs(band * self.step - 90), F.abs((band + 1) * self.step - 90)
        )
        around = 360 * F.cos(F.radians(F.least(farthest, F.lit(90.0))))
        return F.greatest(F.floor(around / self.step), F.lit(1)).cast("int")

    def cell(self, lng: Column, band: Column) -> Column:
        cells = self.cells_in(band)
        return F.pmod(F.floor((lng + 180) * cells / 360), cells).cast("int")

    def reach(self, lat: Column) -> Column:
        """Degrees of longitude that a circle around a point of this latitude reaches to either side."""
        sideways = F.degrees(
            F.asin(F.least(F.sin(F.radians(F.lit(self.step))) / F.cos(F.radians(lat)), F.lit(1.0)))
        )
        # The circle may hold the pole: every longitude.
        return F.when(F.lit(90.0) - F.abs(lat) <= self.step, 180.0).otherwise(sideways * (1 + 1e-9) + 1e-9)

    def piece(self, lat: Column, lng: Column, band: Column, depth: Column) -> Column:
        """Number of the piece of its cell, quartered ``depth`` times, that a point is in."""
        side = F.call_function("shiftleft", F.lit(1).cast("long"), depth)
        turn = (lng + 180) * self.cells_in(band) / 360

        def part(fraction: Column) -> Column:
            return F.greatest(F.lit(0), F.least(F.floor(fraction * side), side - 1))

        return part((lat + 90) / self.step - band) * side + part(turn - F.floor(turn))

    def pieces_touched(self, lat: Column, lng: Column, band: Column, cell: Column, depth: Column) -> Column:
        """All pieces of a cell that a circle around a point may reach."""
        side = F.call_function("shiftleft", F.lit(1).cast("long"), depth)
        width, reach = F.lit(360.0) / self.cells_in(band), self.reach(lat)
        up = lat + 90 - band * self.step
        # The point's distance from the western border, the shorter way round.
        along = F.pmod(lng - cell * width, F.lit(360.0)) - 180
        whole = reach + width >= 180

        def between(low: Column, high: Column, size: Column) -> Column:
            def bound(at: Column) -> Column:
                return F.greatest(F.lit(0), F.least(F.floor(at * side / size), side - 1))

            return F.sequence(bound(low), bound(high))

        everything = F.sequence(F.lit(0).cast("long"), side - 1)
        rows = between(up - self.step * (1 + 1e-9) - 1e-9, up + self.step * (1 + 1e-9) + 1e-9, F.lit(self.step))
        columns = F.when(whole, everything).otherwise(between(along - reach - 1e-9, along + reach + 1e-9, width))
        return F.flatten(F.transform(rows, lambda y: F.transform(columns, lambda x: y * side + x)))

    def touched(self, lat: Column, lng: Column) -> Column:
        """All (band, cell) that a circle around the point may reach."""
        reach = self.reach(lat)

        def cells_of(band: Column) -> Column:
            cells = self.cells_in(band)
            first = F.floor((lng - reach + 180) * cells / 360).cast("int")
            last = F.floor((lng + reach + 180) * cells / 360).cast("int")
            numbers = F.array_distinct(
                F.transform(
                    F.sequence(first, F.least(last, first + cells - 1)),
                    lambda number: F.pmod(number, cells),
                )
            )
            return F.transform(
                numbers, lambda number: F.struct(band.alias("band"), number.alias("cell"))
            )

        lowest = F.greatest(self.band(lat) - 1, F.lit(0))
        highest = F.least(self.band(lat) + 1, F.lit(self.last_band))
        return F.flatten(F.transform(F.sequence(lowest, highest), cells_of))


def pairs_within(
    left: DataFrame,
    right: DataFrame,
    radius_km: float,
    left_point: tuple[str, str],
    right_point: tuple[str, str],
    distance: str = "distanza",
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Every (left, right) pair at most ``radius_km`` apart, with its distance.

    ``left_point`` and ``right_point`` name the (latitude, longitude) columns;
    column names must differ between the two sides. Points with a null coordinate
    have no pairs. No piece of a cell has many more than ``cell_rows`` points of either
    side, except where that many are at one place.
    """
    grid = _Grid(radius_km)
    at, home = ["_band", "_cell"], grid.band(F.col(right_point[0]))
    (lat0, lng0), (lat1, lng1) = ([F.col(name) for name in point] for point in (left_point, right_point))
    reaching = left.withColumn("_at", F.explode(grid.touched(lat0, lng0))).select(
        *left.columns, F.col("_at.band").alias("_band"), F.col("_at.cell").alias("_cell")
    )
    placed = right.withColumn("_band", home).withColumn("_cell", grid.cell(lng1, home))
    dealt, divided = _divided(grid, reaching, placed, (lat0, lng0), (lat1, lng1), cell_rows)
    return (
        dealt.join(divided, [*at, "_piece", "_part"])
        .drop(*at, "_piece", "_part")
        .withColumn(distance, haversine_km(lat0, lng0, lat1, lng1))
        .filter(F.col(distance) <= radius_km)
    )


def _divided(grid: _Grid, reaching: DataFrame, placed: DataFrame, left: tuple, right: tuple, cell_rows: int):
    """Both sides with ``_piece`` and ``_part``: what crowded cells are cut into, 0 in all others."""
    at = ["_band", "_cell"]

    def crowded(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(*at).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > cell_rows)

    over = F.ceil(F.log(F.col("_right") / cell_rows) / math.log(4))
    depth = F.least(F.lit(MOST_DEPTH), over).cast("int")
    deep = F.broadcast(crowded(placed, "_right").select(*at, depth.alias("_depth")))
    parts = F.broadcast(crowded(reaching, "_left").select(*at, F.ceil(F.col("_left") / cell_rows).cast("int").alias("_parts")))

    def known(side: DataFrame) -> DataFrame:
        return (
            side.join(deep, at, "left")
            .join(parts, at, "left")
            .withColumns({"_depth": F.coalesce("_depth", F.lit(0)), "_parts": F.coalesce("_parts", F.lit(1))})
        )

    band, cell, depth = F.col("_band"), F.col("_cell"), F.col("_depth")
    pieces = F.when(depth == 0, F.array(F.lit(0).cast("long"))).otherwise(grid.pieces_touched(*left, band, cell, depth))
    dealt = (
        known(reaching)
        .withColumn("_part", F.pmod(F.xxhash64(*[c for c in reaching.columns if c not in at]), F.col("_parts")).cast("int"))
        .withColumn("_piece", F.explode(pieces))
    )
    divided = (
        known(placed)
        .withColumn("_piece", F.when(depth == 0, F.lit(0).cast("long")).otherwise(grid.piece(*right, band, depth)))
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    )
    return dealt.drop("_depth", "_parts"), divided.drop("_depth", "_parts")


def near_point(
    places: DataFrame,
    lat: float,
    lng: float,
    radius_km: float,
    point: tuple[str, str] = ("lat", "lng"),
    distance: str = "distanza",
) -> DataFrame:
    """Places at most ``radius_km`` from one point.

    A latitude range, and a longitude range where the circle neither holds a
    pole nor crosses the 180th meridian, goes in front of the exact distance so
    that the scan can skip data.
    """
    place_lat, place_lng = (F.col(name) for name in point)
    reach = math.degrees(radius_km / EARTH_RADIUS_KM) * (1 + 1e-9) + 1e-9
    boxed = places
    if reach < 180:
        boxed = boxed.filter(place_lat.between(lat - reach, lat + reach))
    if abs(lat) + reach < 90:
        sideways = math.degrees(math.asin(math.sin(math.radians(reach)) / math.cos(math.radians(lat))))
        sideways = sideways * (1 + 1e-9) + 1e-9
        if -180 <= lng - sideways and lng + sideways <= 180:
            boxed = boxed.filter(place_lng.between(lng - sideways, lng + sideways))
    exact = haversine_km(place_lat, place_lng, F.lit(float(lat)), F.lit(float(lng)))
    return boxed.withColumn(distance, exact).filter(F.col(distance) <= radius_km)
