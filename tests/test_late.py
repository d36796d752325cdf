"""Rows chosen without their texts, and a word join split by frequency: same answers, narrow shuffles, even tasks."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from innsight.operators import late, sentiment
from innsight.operators.skew import frequent_keys, spread_join, top_n
from innsight.plans import classified, digest, words
from workload import views

SF_DIR = "/root/testdata/sf0.001"
TEXTS = {"Positive_Review", "Negative_Review", "review_text"}


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def nodes(df):
    """(name, names of the columns it gives, nodes below) of each node of the plan as first made."""

    def walk(node):
        below = [node.children().apply(k) for k in range(node.children().size())]
        names = {node.output().apply(k).name() for k in range(node.output().size())}
        found = [n for child in below for n in walk(child)]
        return [(node.nodeName(), names, [n[0] for n in found]), *found]

    return walk(df._jdf.queryExecution().executedPlan().initialPlan())


def text_shuffles(df):
    return [below for name, names, below in nodes(df) if name == "Exchange" and names & TEXTS]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("texts") / "flat")
    views.text_reviews(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def alike(spark):
    """Many ties: few hotels, lengths, scores, reviewers and texts; nulls in each column but the id."""
    rng = random.Random(3)

    def some(values):
        return rng.choice([*values, None])

    data = [
        (
            k, some(["h1", "h2"]), some(["c1", "c2"]), some([7.0, 8.0]), some(["aa", "bb", "a", "", "no positive"]),
            some(["cc", "d", "dd"]), rng.choice([1, 2]), some(["2016-01-05", "2016-07-05"]), "addr",
        )
        for k in range(600)
    ]
    columns = "id long, Hotel_Name string, Hotel_City string, Reviewer_Score double, Positive_Review string, " \
        "Negative_Review string, Total_Number_of_Reviews_Reviewer_Has_Given int, day string, Hotel_Address string"
    return spark.createDataFrame(data, columns).withColumn("Review_Date", F.col("day").cast("date"))


def test_extremes_are_those_found_with_texts(stored, alike):
    for df, row_id in ((stored, "review_id"), (alike, "id")):
        assert rows(words.review_length_extremes(df, "Hotel_Name", row_id)) == rows(words.review_length_extremes(df, "Hotel_Name"))
    assert words.review_length_extremes(alike.limit(0), "Hotel_Name", "id").count() == 0


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_digests_are_those_ranked_by_texts(stored, alike, hot_rows):
    named = alike.filter("Hotel_Name is not null")
    for df, row_id in ((stored, "review_id"), (named, "id")):
        for limit in (1, 4, 50):
            plain = rows(digest.review_digest(df, limit, hot_rows=None))
            assert rows(digest.review_digest(df, limit, hot_rows=hot_rows, id_column=row_id)) == plain


@pytest.mark.parametrize("hot_rows", [None, 3])
@pytest.mark.parametrize("order", [("Review_Date", "id"), ("Review_Date", "Positive_Review", "Negative_Review", "Reviewer_Score", "id")])
def test_seasonal_labels_are_those_ranked_by_texts(alike, order, hot_rows):
    def model():
        return lambda batch: batch.map(lambda text: "positive" if "aa" in text else "negative")

    named = alike.filter("Hotel_Name is not null")
    plain = rows(classified.seasonal_label_stats(named, model, 3, order=order, hot_rows=None))
    assert plain and plain == rows(
        classified.seasonal_label_stats(named, model, 3, order=order, hot_rows=hot_rows, id_column="id")
    )


def test_texts_are_shuffled_only_where_the_map_lets_them_through(stored):
    def model():
        return lambda batch: batch

    answers = [
        words.review_length_extremes(stored, "Hotel_Name", "review_id"),
        digest.review_digest(stored, 3, id_column="review_id"),
        classified.seasonal_label_stats(stored, model, 2, order=("Review_Date", "review_id"), id_column="review_id"),
    ]
    for df in answers:
        for below in text_shuffles(df):
            assert "BroadcastHashJoin" in below or "SortMergeJoin" in below
            scans = [n for n in below if n.startswith("Scan")]
            assert len(scans) > 1, "a shuffle of texts straight from the scan"
    # Without ids the whole texts are ranked.
    assert any(len([n for n in below if n.startswith("Scan")]) == 1 for below in text_shuffles(digest.review_digest(stored, 3, hot_rows=None)))


def test_the_map_keeps_all_chosen_and_few_others(spark):
    table = spark.range(200_000).select((F.col("id") * 31 - 77).alias("key"), F.col("id").alias("v"))
    chosen = table.filter("v % 1000 = 3").select("key")
    kept = late.only_ids(table, chosen, "key")
    assert kept.columns == table.columns
    assert kept.join(chosen, "key", "left_semi").count() == 200 and kept.count() < 260
    twice = chosen.union(chosen)
    assert late.fetch(twice, table, "key", ["v"]).count() == 400
    assert late.only_ids(table, chosen.limit(0), "key").count() == 0
    text = "Exchange" not in {name for name, names, _ in nodes(late.only_ids(table, chosen, "key")) if "v" in names}
    assert text


def test_ties_with_the_last_place(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("a", 3, 4), ("b", 5, 5)], "k string, v int, i int")
    got = top_n(df, ["k"], [F.asc("v")], 2, ties=True)
    assert sorted((r.i, r["rank"]) for r in got.collect()) == [(1, 1), (2, 2), (3, 2), (5, 1)]


# A word join split by key frequency


@pytest.fixture(scope="module")
def reviews_of_one_word(spark):
    """One word in nine tenths of 4,000 texts, twice in some; a lexicon of 3,000 words, one listed twice."""
    rng = random.Random(5)
    data = []
    for k in range(4000):
        own = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(0, 6))]
        if k % 10:
            own += ["The,"] * rng.randint(1, 2)
        rng.shuffle(own)
        data.append((k, " ".join(own), None if k % 7 == 0 else "the end"))
    texts = spark.createDataFrame(data, "id long, Positive_Review string, Negative_Review string")
    valences = [(f"w{k}", k / 7 - 3) for k in range(3000)] + [("the", 0.5), ("THE", 0.25), ("unseen", 9.0)]
    return texts, valences


def test_scores_do_not_depend_on_what_counts_as_frequent(spark, reviews_of_one_word):
    texts, valences = reviews_of_one_word
    table = spark.createDataFrame(valences, "word string, valence double")
    mapping = dict(valences[:3000]) | {"the": 0.25, "unseen": 9.0}
    expected = {r.id: round(r.s, 9) for r in sentiment.with_sentiment(texts, mapping, out="s").collect()}
    for hot_rows in (None, 1, 150, 10**6):
        got = sentiment.with_sentiment(texts, table, "id", "s", hot_rows).collect()
        assert {r.id: round(r.s, 9) for r in got} == expected and len(got) == 4000
    assert sentiment.with_sentiment(texts.limit(0), table, "id").count() == 0
    assert {r.s for r in sentiment.with_sentiment(texts, table.limit(0), "id", "s").collect()} == {0.0}


def test_frequent_keys(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 10 > 0, "the").otherwise(F.concat(F.lit("w"), "id")).alias("word"))
    assert [tuple(r) for r in frequent_keys(df, "word", 500, "n").collect()] == [("the", 9000)]
    assert frequent_keys(df.limit(0), "word", 1, "n").count() == 0
    nulls = spark.range(100).select(F.lit(None).cast("string").alias("word"))
    assert frequent_keys(nulls, "word", 1, "n").count() == 0


def test_no_task_gets_most_of_a_frequent_word(spark):
    found = spark.range(60_000).select(
        F.col("id"), F.when(F.col("id") % 10 > 0, "the").otherwise(F.concat(F.lit("w"), F.col("id") % 3000)).alias("word")
    )
    lexicon = found.select("word").distinct().withColumn("valence", F.lit(1.0))
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {name: spark.conf.get(name) for name in held}
    for name, value in held.items():
        spark.conf.set(name, value)
    try:
        hot = F.broadcast(frequent_keys(found, "word", 500, "n"))
        per_key = lexicon.join(hot, "word", "left").withColumn("n", F.coalesce("n", F.lit(1)))
        split = spread_join(found, per_key, "word", "n", ["id"], 500)
        sizes = [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]
        plain = [r["count"] for r in found.join(lexicon, "word").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(sizes) == sum(plain) == 60_000
    assert max(sizes) <= 4 * statistics.median(sizes) and max(plain) > 4 * statistics.median(plain)


def test_plan_of_the_word_join(spark, reviews_of_one_word):
    texts, valences = reviews_of_one_word
    table = spark.createDataFrame(valences, "word string, valence double")
    plan = sentiment.with_sentiment(texts, table, "id")._jdf.queryExecution().executedPlan().toString()
    assert "approx_top_k" in plan and "_salt" in plan
    plain = sentiment.with_sentiment(texts, table, "id", hot_rows=None)._jdf.queryExecution().executedPlan().toString()
    assert "approx_top_k" not in plain and "_salt" not in plain
