"""What is shuffled or held at a time must not grow faster than it has to."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from innsight.operators import scoring
from innsight.operators.sentiment import review_words, with_sentiment
from workload import views

SF_DIR = "/root/testdata/sf0.001"


def below(text, line_with):
    """The part of a plan under the first line that holds ``line_with``."""
    lines = text.splitlines()
    depth = [next((k for k, c in enumerate(line) if c.isalpha()), 0) for line in lines]
    first = next(k for k, line in enumerate(lines) if line_with in line)
    last = next((k for k in range(first + 1, len(lines)) if depth[k] <= depth[first]), len(lines))
    return "\n".join(lines[first + 1 : last])


def test_reviewers_meet_orders_before_line_items(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = views.raw_reviews(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffled = below(plan, "Exchange hashpartitioning(o_custkey")
    assert "o_orderkey" in shuffled and "l_orderkey" not in shuffled


@pytest.mark.parametrize("hot_rows", [None, 5_000_000])
def test_words_not_in_the_lexicon_are_dropped_where_they_are_read(spark, hot_rows):
    from innsight.operators.sentiment import _listed

    rows = [(k, " ".join(f"w{k * 40 + n}" for n in range(40)) + " Good, good", None if k % 2 else "BAD") for k in range(100)]
    reviews = spark.createDataFrame(rows, "id long, Positive_Review string, Negative_Review string")
    lexicon = spark.createDataFrame([("good", 1.0), ("Bad", -3.0), ("absent", 5.0)], "word string, valence double")
    worded = reviews.select("id", review_words(F.col("Positive_Review"), F.col("Negative_Review")).alias("_words"))
    listed = _listed(worded, lexicon.select(F.lower("word").alias("word")), "id")
    assert 250 <= listed.count() < 300
    scored = with_sentiment(reviews, lexicon, "id", hot_rows=hot_rows).collect()
    mapped = with_sentiment(reviews, {"good": 1.0, "bad": -3.0, "absent": 5.0}).collect()
    assert sorted((r.id, round(r.Sentiment_Score, 9)) for r in scored) == sorted((r.id, round(r.Sentiment_Score, 9)) for r in mapped)


def test_a_model_sees_pieces_of_a_batch(spark):
    def make():
        def held(texts):
            assert texts.index.tolist() == list(range(len(texts)))
            return pd.Series([None if t is None else f"{t[:4]} {texts.str.len().sum():.0f}" for t in texts])

        return held

    text = F.when(F.col("id") % 9 == 0, None).otherwise(F.concat(F.lpad(F.col("id").cast("string"), 4, "0"), F.repeat(F.lit("x"), 2996)))
    rows = spark.range(0, 900, 1, 1).select("id", scoring.score_text(text, make).alias("said")).collect()
    assert all((r.said is None) == (r.id % 9 == 0) for r in rows) and len(rows) == 900
    found = [r.said.split() for r in rows if r.said]
    assert all(int(said) == r.id for (said, _), r in zip(found, [r for r in rows if r.said], strict=True))
    assert max(int(total) for _, total in found) <= scoring.PIECE_CHARS


def test_pieces_keep_every_text():
    texts = [None, "aaa", "", "b" * 9, "cc", "dd", None, "e"]
    found = [p.tolist() for p in scoring.pieces(pd.Series(texts, dtype=object), 4)]
    assert found == [[None, "aaa", ""], ["b" * 9], ["cc", "dd", None], ["e"]]
    assert [len(p) for p in scoring.pieces(pd.Series([], dtype=object))] == [0]
