"""What the physical plans must and must not hold."""

import re

import pytest

from innsight.operators.sentiment import with_sentiment
from innsight.plans import classified, hotels, nearby, places, seasons, words
from workload import views
from workload.queries import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("reviews") / "flat")
    columns = [
        "Hotel_Name", "Hotel_City", "Hotel_Nationality", "lat", "lng", "Average_Score", "Review_Date",
        "Reviewer_Score", "Reviewer_Nationality", "Positive_Review", "Negative_Review", "Tags",
    ]
    views.reviews(spark, SF_DIR, *columns).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(df):
    return [set(re.findall(r"(\w+)#", scan)) for scan in re.findall(r"FileScan parquet \[([^\]]*)\]", plan(df))]


@pytest.mark.parametrize("name", queries())
def test_no_python_rows_and_no_nested_loops(spark, name):
    text = plan(queries()[name](spark, SF_DIR))
    assert "BatchEvalPython" not in text
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    models = ("classified_sentiment_model", "seasonal_label_stats", "seasonal_label_stats_hot", "hotel_summaries")
    assert "REPARTITION_BY_NUM" not in text
    assert ("ArrowEvalPython" in text) == (name in models)


def test_rankings_are_cut_before_the_shuffle(stored):
    for df in (places.top_hotels_by_city(stored), places.cities_by_reviewer_nationality(stored)):
        text = plan(df)
        assert re.search(r"WindowGroupLimit .*Partial", text) and re.search(r"WindowGroupLimit .*Final", text)


def test_reviews_are_summed_once_for_ranking_and_city_means(stored):
    df = places.top_hotels_by_city(stored)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_filters_and_columns_reach_the_scan(stored):
    one = hotels.fact_sheet(stored, hotel="Supplier#000000001")
    assert "PushedFilters: [IsNotNull(Hotel_Name), EqualTo(Hotel_Name,Supplier#000000001)]" in plan(one)
    assert read_columns(one) == [{"Hotel_Name", "Reviewer_Score", "lat", "lng"}]
    assert read_columns(words.tag_frequency(stored)) == [{"Tags"}]
    near = nearby.hotels_near_point(stored, 45.0, 9.0, 10.0)
    assert read_columns(near) == [{"Hotel_Name", "Hotel_City", "lat", "lng", "Reviewer_Score"}]


def test_sentiment_of_a_row_needs_no_shuffle(stored):
    assert "Exchange" not in plan(with_sentiment(stored, views.LEXICON))


def test_extremes_take_one_pass_without_windows(stored):
    text = plan(words.review_length_extremes(stored))
    assert text.split("== Initial Plan ==")[0].count("FileScan") == 1 and "Window" not in text


def below_first_aggregate(df):
    """Nodes between the scan and the aggregate above it, bottom up."""
    lines = plan(df).split("== Initial Plan ==")[-1].splitlines()
    scans = [k for k, line in enumerate(lines) if "FileScan" in line]
    found = []
    for k in reversed(range(scans[-1])):
        found.append(lines[k])
        if "Aggregate" in lines[k]:
            break
    return found


def test_reviews_are_not_sorted_to_be_aggregated(spark):
    texts = views.text_reviews(spark, SF_DIR)
    for df in (
        words.review_length_extremes(texts, by="Hotel_Name"),
        seasons.sentiment_by_hotel_season(texts, views.LEXICON),
        classified.hotel_sentiment(texts, classified.lexicon_label(views.LEXICON)),
    ):
        below = below_first_aggregate(df)
        assert "HashAggregate" in below[-1] and not any("Sort" in line for line in below)


def test_one_pass_near_a_point(stored):
    sights = stored.sparkSession.sql("select 'x' as nome, 45D as lat, 9D as lng")
    for df in (nearby.hotels_near_point(stored, 45.0, 9.0, 3000.0), nearby.hotels_near_sights(stored, sights, 3000.0)):
        assert df.collect()
        assert plan(df).split("== Initial Plan ==")[0].count("FileScan") == 1


def test_whole_table_answers_are_not_sorted(stored):
    for df in (hotels.anomalous_reviews(stored), hotels.monthly_trend(stored), nearby.hotels_near_hotel(stored)):
        assert "rangepartitioning" not in plan(df)
