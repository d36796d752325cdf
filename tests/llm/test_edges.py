"""Every operator on rows of nulls, empty and long texts, repeated rows, and on no rows at all."""

import random
import string

import pytest

from innsight.llm import (
    counting, decontamination, lines, personal, quality, secrets, sharding, simhash, tokens, warc,
)
from innsight.llm.common import shared_dir
from innsight.llm.queries import vocabulary

BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"

PER_ROW = {
    "simhash": simhash.near_duplicates,
    "lines": lines.report,
    "secrets": secrets.scan,
    "quality": quality.score,
    "sharding": lambda docs: sharding.assign(docs, [1.0, 2.0, 3.0]),
    "personal": personal.find,
    "bpe": lambda docs: tokens.round_trip(docs, vocabulary(BPE)),
    "counts": lambda docs: counting.count_tokens(docs, vocabulary(PIECES)),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_each_row(edge_docs, name):
    ids = sorted(str(r.doc_id) for r in PER_ROW[name](edge_docs).collect())
    assert ids == sorted(str(r.doc_id) for r in edge_docs.select("doc_id").collect())


@pytest.mark.parametrize("name", PER_ROW)
def test_no_rows(no_docs, name):
    assert PER_ROW[name](no_docs).count() == 0


def test_filters_keep_all_columns(edge_docs, no_docs, spark):
    items = spark.createDataFrame([(1, "one two three four five"), (2, None), (None, "a b c d e")], "item_id long, text string")
    for stage in (quality.keep, lines.keep, simhash.keep_one, lambda d: decontamination.keep(d, items)):
        assert stage(edge_docs).columns == edge_docs.columns
        assert stage(edge_docs).count() <= edge_docs.count()
        assert stage(no_docs).count() == 0
    assert decontamination.keep(edge_docs, items.limit(0)).count() == edge_docs.count()


def test_pages(spark):
    rows = [
        (1, "http://a/é\n", "x" * 100, "n"), (2, None, "x" * 100, "n"), (3, "u", None, "n"), (4, "u", "", "n"),
        (None, "u", "x" * 100, "n"), (2, None, "x" * 100, "n"), (5, "u", "short", "n"), (6, "u", "short", "n"),
        (7, "u", "é" * 200_000, "n"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    folder = f"{shared_dir(spark)}/edge-pages"
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages, folder).collect())
    assert got == sorted([
        ("1", 100, "response", None), ("2", 100, "revisit", 1), ("2", 100, "revisit", 1), ("3", 0, "response", None),
        ("4", 0, "response", None), ("None", 100, "revisit", 1), ("5", 5, "response", None),
        ("6", 5, "response", None), ("7", 400_000, "response", None),
    ])
    assert warc.round_trip(pages.limit(0), f"{shared_dir(spark)}/no-pages").count() == 0


def test_filters_keep_columns_of_their_own_names(spark):
    names = "doc_id long, text string, source string, n_chars int, removed string, id_of_kept int, ID_OF_REMOVED int, `a.b` int"
    shared = "a line that every site has\n"
    rows = [(n, f"{shared}own words {'abcdefgh'[n] * 9} of number {n}", f"s{n}", 99, "r", n, n, n) for n in range(6)]
    docs = spark.createDataFrame([*rows, rows[5]], names)
    left = lines.keep(docs)
    assert left.schema == docs.schema
    first, *others = sorted(left.collect())
    assert first == rows[0] and all(r.text == rows[r.doc_id][1].removeprefix(shared) for r in others)
    assert len(others) == 6 and all(r.n_chars == len(r.text) and r.removed == "r" for r in others)
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema and kept.count() == docs.distinct().count()


def test_texts_that_share_an_id_stand_for_their_own_components(spark):
    rows = [(1, "alpha beta gamma delta epsilon"), (1, "quite another text of other words"), (2, "alpha beta gamma delta epsilon")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(simhash.keep_one(docs).collect()) == rows[:2]


def test_a_very_long_key(spark):
    """Symbols are looked up one after the other, not each from the front of the text."""
    rng = random.Random(3)
    blob = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(1_000_000))
    (row,) = secrets.scan(spark.createDataFrame([(1, f"see {blob} there")], "doc_id long, text string")).collect()
    assert (row.n_random, row.spans) == (1, "random:4:1000004")
