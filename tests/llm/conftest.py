import pytest

from innsight.llm import common


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    common.ship(spark)
    common.shared_dir(spark)


@pytest.fixture
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, a clashing extra column."""
    rows = [
        (1, None, "a", "x"), (2, "", "a", None), (3, " \n\t", None, "x"), (None, "one two three", "b", "x"),
        (4, "word " * 60_000, "c", "x"), (5, "z" * 200_000, "c", "x"), (6, "same text here\n" * 3, "a", "x"),
        (6, "same text here\n" * 3, "a", "x"), (7, "é😀  token: abcdef12", "a", "x"), (None, None, None, None),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, fp string")


@pytest.fixture
def no_docs(edge_docs):
    return edge_docs.limit(0)
