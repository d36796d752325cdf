"""Joins and rankings when one key has most of the rows."""

from collections import defaultdict

from pyspark.sql import functions as F

from innsight.operators.skew import hot_keys, spread_join, top_n
from innsight.plans import classified, digest, hotels
from workload import views

SF_DIR = "/root/testdata/sf0.001"


def skewed(spark):
    return spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        (F.col("id") * 7919 % 1000).alias("v"),
        F.col("id").alias("i"),
    )


def rows(df):
    return sorted(tuple(row) for row in df.select(*sorted(df.columns)).collect())


def test_hot_keys(spark):
    assert [row.k for row in hot_keys(skewed(spark), ["k"], 100).collect()] == ["hot"]
    assert hot_keys(skewed(spark), ["k"], 2000).count() == 0


def test_spread_join_equals_plain_join(spark):
    df = skewed(spark)
    sums = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("m"))
    plain = rows(df.join(sums, "k"))
    for hot_rows in (1, 7, 100, 10_000):
        assert rows(spread_join(df, sums, "k", "n", ["v", "i"], hot_rows)) == plain


def test_spread_join_splits_the_hot_key(spark):
    df = skewed(spark)
    sums = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("m"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = spread_join(df, sums, "k", "n", ["i"], 100)
        sizes = joined.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 4


def test_top_n_equals_brute_force(spark):
    df = skewed(spark)
    groups = defaultdict(list)
    for row in df.collect():
        groups[row.k].append((row.v, row.i))
    expected = sorted(
        (i, k, rank, v)
        for k, members in groups.items()
        for rank, (v, i) in enumerate(sorted(members)[:5], start=1)
    )
    order = [F.asc("v"), F.asc("i")]
    assert rows(top_n(df, ["k"], order, 5)) == expected
    for hot_rows in (1, 100, 10_000):
        hot = hot_keys(df, ["k"], hot_rows)
        assert rows(top_n(df, ["k"], order, 5, hot=hot, pieces=4)) == expected


def test_plans_do_not_depend_on_what_counts_as_hot(spark):
    reviews = views.reviews(
        spark, SF_DIR, "Hotel_Name", "Reviewer_Score", "Review_Date", "Positive_Review", "Negative_Review"
    )
    plain = rows(hotels.anomalous_reviews(reviews))
    assert plain and rows(hotels.anomalous_reviews(reviews, hot_rows=50)) == plain
    texts = views.text_reviews(spark, SF_DIR)
    plain = rows(digest.review_digest(texts, limit=3, hot_rows=None))
    assert rows(digest.review_digest(texts, limit=3, hot_rows=4)) == plain

    def model():
        return lambda batch: batch.map(lambda text: "positive" if "the" in text else "negative")

    order = ("Review_Date", "review_id")
    plain = rows(classified.seasonal_label_stats(texts, model, 2, order=order, hot_rows=None))
    assert rows(classified.seasonal_label_stats(texts, model, 2, order=order, hot_rows=1)) == plain
