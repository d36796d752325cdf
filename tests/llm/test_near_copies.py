"""One row of each component of near copies stays."""

from innsight.llm import simhash


def test_copies_without_id(spark):
    text, other = "one two three four five six", "words of another text that has no name"
    docs = spark.createDataFrame([(None, text), (1, text), (None, other), (None, other), (None, None)], "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_one(docs).collect()), key=str) == sorted(
        [(1, text), (None, other), (None, None)], key=str
    )
