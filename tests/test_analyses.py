"""Rules that hold of the answers, and answers for one hotel against all."""

import math
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from innsight.operators.sentiment import lexicon_score, with_sentiment
from innsight.plans import classified, digest, hotels, places, seasons, words
from workload import views
from workload.queries import CHAT_OUTPUT, CLASSIFIER_OUTPUT, toy_model

SF_DIR = "/root/testdata/sf0.001"
REVIEW = ("Hotel_Name", "Hotel_City", "Hotel_Nationality", "Reviewer_Score", "Review_Date")


@pytest.fixture(scope="module")
def reviews(spark):
    return views.reviews(
        spark, SF_DIR, *REVIEW, "Average_Score", "lat", "lng", "Reviewer_Nationality",
        "Positive_Review", "Negative_Review", "Tags",
    ).cache()


@pytest.fixture(scope="module")
def texts(spark):
    return views.text_reviews(spark, SF_DIR).cache()


def rows(df):
    return sorted(map(str, df.collect()))


def test_foreign_keys_are_complete(spark):
    lines = views.table(spark, SF_DIR, "lineitem").count()
    everything = views.reviews(spark, SF_DIR, *REVIEW, "Reviewer_Nationality", "Tags")
    assert lines == everything.count() == views.reviews(spark, SF_DIR, "Reviewer_Score").count()


@pytest.mark.parametrize(
    "plan",
    [
        hotels.mean_score,
        hotels.monthly_trend,
        hotels.reputation,
        hotels.anomalous_reviews,
        hotels.fact_sheet,
    ],
)
def test_one_hotel_is_a_part_of_all(reviews, plan):
    name = "Supplier#000000003"
    one = plan(reviews, hotel=name)
    assert rows(one) == rows(plan(reviews).filter(F.col("Hotel_Name") == name)) != []
    assert plan(reviews, hotel="nobody").count() == 0


def test_rankings(reviews):
    best = places.top_hotels_by_city(reviews, n=2).collect()
    assert {row["rank"] for row in best} <= {1, 2}
    city = best[0].Hotel_City
    assert rows(places.top_hotels_by_city(reviews, 2, city=city)) == sorted(
        str(row) for row in best if row.Hotel_City == city
    )
    cities = places.cities_by_reviewer_nationality(reviews, top=3).collect()
    by_nation = {}
    for row in cities:
        by_nation.setdefault(row.Reviewer_Nationality, []).append(row)
    for found in by_nation.values():
        assert [row["rank"] for row in found] == list(range(1, len(found) + 1))
        assert [row.avg_score for row in found] == sorted((row.avg_score for row in found), reverse=True)
    nation = cities[0].Reviewer_Nationality
    assert rows(places.cities_by_reviewer_nationality(reviews, 3, nation)) == sorted(
        map(str, by_nation[nation])
    )


def test_unknown_is_left_out_on_demand(spark):
    df = spark.createDataFrame(
        [("Unknown", "Milan", 9.0), ("italy", "Milan", 8.0), (None, "Milan", 7.0)],
        "Reviewer_Nationality string, Hotel_City string, Reviewer_Score double",
    )
    assert [row[0] for row in places.distinct_values(df, "Reviewer_Nationality").collect()] == ["italy"]
    kept = places.cities_by_reviewer_nationality(df, exclude_unknown=True).collect()
    assert [row.Reviewer_Nationality for row in kept] == ["italy"]


def test_overview_adds_up(reviews):
    exactly_six = reviews.filter("Reviewer_Score = 6").count()
    total = places.city_overview(reviews).agg(
        F.sum("Total_Reviews"), F.sum(F.col("TotalN") + F.col("TotalP"))
    ).first()
    assert total[0] == reviews.count() == total[1] + exactly_six


def test_reputation_without_recent_reviews(spark):
    df = spark.sql("""select * from values
        ('old', date '2016-01-01', 8D), ('new', date '2017-01-31', 6D), ('new', date '2017-01-01', 9D),
        ('new', date '2016-12-31', 3D) as t(Hotel_Name, Review_Date, Reviewer_Score)""")
    found = {row.Hotel_Name: row for row in hotels.reputation(df).collect()}
    assert (found["new"].media_ultimi_30gg, found["new"].reputazione, found["new"].andamento) == (7.5, 1.5, "migliorando")
    assert (found["old"].media_ultimi_30gg, found["old"].reputazione, found["old"].andamento) == (None, None, "sconosciuta")


def test_single_review_is_no_anomaly(spark):
    df = spark.sql("""select * from values ('one', date '2016-01-01', 8D, 'a', 'b')
        as t(Hotel_Name, Review_Date, Reviewer_Score, Positive_Review, Negative_Review)""")
    assert hotels.anomalous_reviews(df).count() == 0


def test_tags(reviews):
    counts = {row.word: row["count"] for row in words.tag_frequency(reviews).collect()}
    assert sum(counts.values()) == 3 * reviews.count()
    ordered = [row.word for row in words.tag_frequency(reviews).collect()]
    assert [row.word for row in words.most_used_tags(reviews, 4).collect()] == ordered[:4]
    assert [row.word for row in words.least_used_tags(reviews, 4).collect()] == ordered[:-5:-1]


def test_word_scores_do_not_depend_on_the_dictionary_size(spark, texts):
    dictionary = views.lexicon(spark)
    small = rows(words.word_scores(texts, dictionary, 5))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = rows(words.word_scores(texts, dictionary, 5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert small == large != []
    first = words.negative_word_scores(texts, dictionary, 1, n=2).collect()
    assert [row.avg_score for row in first] == sorted(row.avg_score for row in first) and len(first) == 2


def test_length_extremes_per_city(texts):
    found = words.review_length_extremes(texts, by="Hotel_Nationality").collect()
    lengths = {}
    for row in texts.collect():
        for kind, text in (("positiva", row.Positive_Review), ("negativa", row.Negative_Review)):
            lengths.setdefault((row.Hotel_Nationality, kind), []).append(len(text))
    assert len(found) == 2 * len(lengths)
    for (nation, kind), sizes in lengths.items():
        got = {row.length for row in found if (row.by_Hotel_Nationality, row.type) == (nation, kind)}
        assert got == {min(sizes), max(sizes)}


def brute_force_score(text, lexicon):
    total = sum(
        lexicon.get(word.strip(string.punctuation), 0.0)
        for word in re.split(r"[ \t\n\x0b\f\r]+", text.lower())
    )
    return total / math.sqrt(total * total + 15)


def test_sentiment_against_brute_force(spark, texts):
    vocabulary = sorted({word for row in texts.collect() for word in row.Positive_Review.split()})
    rnd = random.Random(5)
    lexicon = {word.strip(string.punctuation): rnd.randint(-16, 16) / 4 for word in vocabulary[::3]}
    lexicon.pop("", None)
    rows_ = with_sentiment(texts, lexicon).collect()
    for row in rows_:
        expected = brute_force_score(f"{row.Positive_Review}. {row.Negative_Review}", lexicon)
        assert row.Sentiment_Score == pytest.approx(expected, abs=1e-12)
        assert -1 <= row.Sentiment_Score <= 1
    table = spark.createDataFrame(list(lexicon.items()), "word string, valence double")
    joined = {r.review_id: r.Sentiment_Score for r in with_sentiment(texts, table, "review_id").collect()}
    assert joined == {r.review_id: r.Sentiment_Score for r in rows_}


def test_lexicon_table_needs_a_key_and_a_mapping_has_no_limit(spark, texts):
    with pytest.raises(ValueError):
        with_sentiment(texts, views.lexicon(spark))
    many = {f"word{k}": 1.0 for k in range(60_000)} | views.LEXICON
    some = texts.limit(5)
    assert rows(with_sentiment(some, many)) == rows(with_sentiment(some, views.LEXICON))


def test_season_counts_add_up(texts):
    per_season = seasons.sentiment_by_hotel_season(texts, views.LEXICON)
    assert per_season.agg(F.sum("Num_Reviews")).first()[0] == texts.count()
    hotel = texts.first().Hotel_Name
    one = seasons.sentiment_by_hotel_season(texts, views.LEXICON, hotel=hotel)
    assert rows(one) == rows(per_season.filter(F.col("Hotel_Name") == hotel))
    best = seasons.best_and_worst_season(texts, views.LEXICON).collect()
    assert all(row.Best_Sentiment >= row.Worst_Sentiment for row in best)


def test_model_labels(spark, texts):
    counted = classified.hotel_sentiment(texts, classified.model_label(toy_model(CLASSIFIER_OUTPUT)))
    for row in counted.collect():
        assert row.Positive_Count + row.Neutral_Count + row.Negative_Count == row.Num_Reviews
        assert row.Average_Sentiment_Score == pytest.approx(
            (row.Positive_Count - row.Negative_Count) / row.Num_Reviews, abs=0.0005 + 1e-9
        )
    blank = spark.createDataFrame(
        [("H", "a", " ", None), ("H", "a", None, None), ("H", "a", "and", "")],
        "Hotel_Name string, Hotel_Address string, Positive_Review string, Negative_Review string",
    )
    (row,) = classified.hotel_sentiment(
        blank, classified.model_label(toy_model({1: "positive", 0: "negative", -1: "negative"}))
    ).collect()
    assert (row.Positive_Count, row.Neutral_Count, row.Negative_Count) == (1, 2, 0)
    assert row.Sentiment == "Il sentiment medio dell'hotel H è piuttosto positivo 😄"


def test_model_sees_the_chosen_reviews_only(spark, texts):
    seen = spark.sparkContext.accumulator(0)

    def counting():
        def score(batch):
            seen.add(len(batch))
            return batch.map(lambda _: "neutral")

        return score

    stats = classified.seasonal_label_stats(texts, counting, per_season=1, hot_rows=None).collect()
    assert seen.value == len(stats) == sum(row.Num_Reviews for row in stats)
    assert CHAT_OUTPUT[0] and all(row.Avg_Sentiment_Score == 0 for row in stats)


def test_digest(spark):
    rows_ = [
        ("H", 3, "good", "bad"),
        ("H", 1, "first", "worst"),
        ("H", 1, "No positive comment", "dirty"),
        ("H", 0, "no positive", "dirty"),
        ("H", 0, "fine", "no negative"),
        ("I", 0, "fine", "No negative comment"),
    ]
    df = spark.createDataFrame(
        rows_,
        "Hotel_Name string, Total_Number_of_Reviews_Reviewer_Has_Given int, Positive_Review string, Negative_Review string",
    )
    (row,) = digest.review_digest(df).collect()
    assert row.num_reviews == 2
    assert row.prompt.endswith(":\nPositiva: first | Negativa: worst. Positiva: good | Negativa: bad. ")
    assert digest.review_digest(df, limit=1, hotel="H").first().prompt.endswith("worst. ")


def test_cities_under_either_name(spark, reviews):
    centres = spark.createDataFrame(
        [("Citta", 1.0, 2.0, reviews.first().Hotel_City), ("Altrove", 3.0, 4.0, "Altrove")],
        "city string, lat double, lng double, alias string",
    )
    found = places.hotels_of_known_cities(reviews, centres).collect()
    assert {(row.city, row.Hotel_City) for row in found} == {("Citta", reviews.first().Hotel_City)}


def test_place_of_a_chain_is_one_of_its_sites(spark):
    rows = [("h", 7.0, 45.0, 9.0), ("h", 5.0, 41.0, 12.0), ("h", 6.0, None, 1.0), ("g", 4.0, None, None)]
    found = {r.Hotel_Name: r for r in hotels.fact_sheet(
        spark.createDataFrame(rows, "Hotel_Name string, Reviewer_Score double, lat double, lng double")
    ).collect()}
    assert (found["h"].Latitude, found["h"].Longitude, found["h"].Avg_Reviewer_Score) == (41.0, 12.0, 6.0)
    assert (found["h"].Total_Reviews, found["h"].Total_Positive_Reviews, found["h"].Total_Negative_Reviews) == (3, 2, 1)
    assert (found["g"].Latitude, found["g"].Longitude) == (None, None)


def test_map_has_one_row_per_outline(spark, texts):
    spelled = texts.withColumn("Hotel_Nationality", F.when(F.col("review_id") % 2 == 0, "ITALY").otherwise("Italy"))
    outlines = spark.sql("select 'Italy' as name union all select 'France'")
    found = {r.name: r.sentiment for r in seasons.sentiment_map(spelled, outlines, views.LEXICON).collect()}
    whole = seasons.sentiment_by_nation(texts.withColumn("Hotel_Nationality", F.lit("x")), views.LEXICON).first()
    assert found == {"Italy": whole.mean_sentiment, "France": None}


def test_model_is_told_what_to_do(texts):
    untold = classified.seasonal_label_stats(texts, toy_model(CHAT_OUTPUT, "Another instruction"), order=("review_id",))
    assert {r.Avg_Sentiment_Score for r in untold.collect()} == {0.0}
