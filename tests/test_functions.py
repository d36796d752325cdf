"""Column functions on single values."""

import pytest
from pyspark.sql import functions as F

from innsight.functions import bands, dates, geo, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("output", "label"),
    [
        ("The review is Positive.", 1),
        ("neutral, maybe negative", 0),
        ("NEGATIVE", -1),
        ("not positive but negative", 1),
        ("no idea", 0),
        (None, 0),
    ],
)
def test_label_parsing(spark, output, label):
    assert value(spark, text.parse_label(F.lit(output).cast("string"))) == label


@pytest.mark.parametrize(
    ("output", "shown"),
    [
        ("<think>let me\nsee</think>\n\nA fine hotel. ", "A fine hotel."),
        ("<think>a</think>x<think>b</think>y", "xy"),
        ("<think>a<think>b</think>c</think>", "c</think>"),
        ("</think> stray <think>", "</think> stray <think>"),
        ("plain", "plain"),
    ],
)
def test_reasoning_is_stripped(spark, output, shown):
    assert value(spark, text.strip_reasoning(F.lit(output))) == shown


def test_seasons(spark):
    expected = ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]
    for month, season in enumerate(expected, start=1):
        assert value(spark, dates.season(F.make_date(F.lit(2016), F.lit(month), F.lit(1)))) == season
    assert value(spark, dates.season(F.lit(None).cast("date"))) == "Unknown"
    assert value(spark, dates.year_month(F.make_date(F.lit(2016), F.lit(3), F.lit(9)))) == "2016-03"


@pytest.mark.parametrize(
    ("band", "cases"),
    [
        (bands.score_band, {8.5: "molto alto", 8.4: "alto", 7.0: "alto", 5.5: "medio", 5.4: "basso", None: None}),
        (bands.reputation_trend, {0.1: "migliorando", 0.0: "peggiorando", -1.0: "peggiorando", None: "sconosciuta"}),
        (bands.sentiment_band, {0.21: "positivo", 0.2: "neutrale", -0.2: "neutrale", -0.21: "negativo", None: None}),
        (
            bands.map_bin,
            {
                0.36: "Sentiment < 0.37",
                0.37: "0.37 <= Sentiment < 0.39",
                0.39: "0.39 <= Sentiment < 0.41",
                0.41: "Sentiment >= 0.41",
                None: "no data",
            },
        ),
        (bands.label_from_score, {0.05: "positive", 0.0: "neutral", -0.05: "negative", None: "neutral"}),
    ],
)
def test_bands(spark, band, cases):
    for score, expected in cases.items():
        assert value(spark, band(F.lit(score).cast("double"))) == expected


def test_combined_review_of_nulls(spark):
    nothing = F.lit(None).cast("string")
    assert value(spark, text.combined_review(nothing, nothing)) == ". "
    assert value(spark, text.combined_review(F.lit("good"), F.lit("bad"))) == "good. bad"


@pytest.mark.parametrize(
    ("a", "b", "km"),
    [
        ((45.4642, 9.19), (45.4642, 9.19), 0.0),
        ((0.0, 0.0), (0.0, 90.0), 10007.543398),
        ((0.0, 0.0), (0.0, 180.0), 20015.086796),
        ((90.0, 5.0), (-90.0, 77.0), 20015.086796),
        ((51.5074, -0.1278), (48.8566, 2.3522), 343.556060),
    ],
)
def test_distance(spark, a, b, km):
    found = value(spark, geo.haversine_km(*[F.lit(x) for x in (*a, *b)]))
    assert found == pytest.approx(km, abs=1e-5)
