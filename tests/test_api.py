"""The methods of one object from raw files to answers."""

import inspect

import pytest

from innsight import HotelReviews
from tests.test_ingest import raw
from workload import views
from workload.queries import CLASSIFIER_OUTPUT, toy_model, toy_summariser


def test_every_question_from_raw_files(spark, tmp_path):
    changes = [
        {"Reviewer_Score": str(score), "Review_Date": f"{month}/3/2017", "Positive_Review": f" good and {score} "}
        for score in (2, 6, 7, 9)
        for month in (1, 4, 7)
    ]
    changes += [{"Hotel_Name": "Hotel B", "lat": "51.501"}]
    raw(spark, *changes).write.option("header", True).csv(str(tmp_path / "raw"))
    table = HotelReviews.from_csv(
        spark, str(tmp_path / "raw"), lexicon=views.LEXICON, dictionary=views.lexicon(spark)
    )
    assert table.reviews.count() == 13
    given = {
        "distinct_values": ["Hotel_City"],
        "hotels_of_known_cities": [spark.sql("select 'Londra' as city, 'London' as alias, 51.5D as lat, 0D as lng")],
        "sentiment_map": [spark.sql("select 'UNITED KINGDOM' as name")],
        "hotels_near_point": [51.5, -0.1],
        "hotels_near_sights": [spark.sql("select 'x' as nome, 51.5D as lat, -0.1D as lng")],
        "seasonal_label_stats": [toy_model(CLASSIFIER_OUTPUT)],
        "summaries": [toy_summariser()],
    }
    empty = {"tag_influence", "anomalous_reviews", "rows_with_blanks"}
    for name, method in inspect.getmembers(table, inspect.ismethod):
        if name.startswith("_") or name in ("from_csv", "peek", "word_scores"):
            continue
        assert (method(*given.get(name, [])).count() > 0) == (name not in empty), name
    positive, negative = table.word_scores(min_frequency=2)
    assert [tuple(row) for row in positive.collect()] == [("and", 6.0, 12)]
    assert negative.count() == 0
    assert table.summaries(toy_summariser(), "Hotel A").first().summary == "12 reviews"
    table.peek(1)


def test_lexicon_table_needs_the_review_id(spark, tmp_path):
    raw(spark, {"Positive_Review": "good and cheap"}, {}).write.option("header", True).csv(str(tmp_path / "raw"))
    path = str(tmp_path / "raw")
    by_mapping = HotelReviews.from_csv(spark, path, lexicon=views.LEXICON)
    by_table = HotelReviews.from_csv(spark, path, with_id=True, lexicon=views.lexicon(spark))
    assert by_mapping.sentiment_by_season().collect() == by_table.sentiment_by_season().collect()
    assert by_mapping.sentiment_by_season().first().Avg_Sentiment_Score > 0


def test_missing_dictionaries_are_errors(spark, tmp_path):
    raw(spark, {}).write.option("header", True).csv(str(tmp_path / "raw"))
    table = HotelReviews.from_csv(spark, str(tmp_path / "raw"))
    for question in (table.sentiment_by_season, table.sentiment_by_nation, table.classified_sentiment, table.word_scores):
        with pytest.raises(ValueError, match="needs a"):
            question()


def test_lexicon_table_labels_hotels(spark, tmp_path):
    raw(spark, {"Positive_Review": "good and cheap"}, {}).write.option("header", True).csv(str(tmp_path / "raw"))
    path = str(tmp_path / "raw")
    by_mapping = HotelReviews.from_csv(spark, path, lexicon=views.LEXICON)
    by_table = HotelReviews.from_csv(spark, path, with_id=True, lexicon=views.untidy_lexicon(spark))
    found = by_table.classified_sentiment().collect()
    assert found == by_mapping.classified_sentiment().collect() and found[0].Positive_Count > 0


def test_options_reach_the_questions(spark, tmp_path):
    raw(spark, {"Reviewer_Nationality": " "}, {"Hotel_Name": "Hotel B"}).write.option("header", True).csv(str(tmp_path / "raw"))
    table = HotelReviews.from_csv(spark, str(tmp_path / "raw"))
    nationalities = {r[0] for r in table.distinct_values("Reviewer_Nationality").collect()}
    assert "Unknown" not in nationalities
    assert "Unknown" in {r[0] for r in table.distinct_values("Reviewer_Nationality", False).collect()}
    assert table.favourite_cities(exclude_unknown=True).count() < table.favourite_cities().count()
    assert table.most_used_tags(1).count() == table.least_used_tags(1).count() == 1
    assert {r.num_reviews for r in table.review_digest(limit=1).collect()} == {1}
    assert table.summaries(toy_summariser(), limit=1).first().summary == "1 reviews"
