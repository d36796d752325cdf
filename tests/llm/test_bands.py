"""Bands of compression ratios fitted on labels."""

import math
import random

import pytest

from innsight.llm import quality

SF_DIR = "/root/testdata/sf0.1"


def _allowed(good, size):
    """The band of a length by its definition, over all good texts one by one."""
    own = math.floor(math.log2(size) * 4)
    near = sorted(r for n, r in good if abs(math.floor(math.log2(n) * 4) - own) <= 1)
    if len(near) < 20:
        return next((least, most) for below, least, most in quality.BANDS if size < below)
    last = math.ceil(0.998 * len(near)) - 1
    return near[len(near) - 1 - last] * 0.99, near[last] * 1.01


def test_limits_by_length():
    rng = random.Random(1)
    good = [(rng.randint(50, 40_000), rng.uniform(1.5, 2.5)) for _ in range(600)]
    bands = quality.limits(good)
    assert [below for below, *_ in bands] == sorted(below for below, *_ in bands) and bands[-1][0] == float("inf")
    for size in [*range(45, 4000, 7), 9_999, 33_000, 100_000]:
        least, most = next((least, most) for below, least, most in bands if size < below)
        assert (least, most) == pytest.approx(_allowed(good, size)), size
    assert quality.limits([]) == quality.BANDS


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a text"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 1), (1, 0)], "doc_id long, quality int")
    assert quality.fit(docs, labels) == quality.BANDS == quality.fit(docs.limit(0), labels.limit(0))


def test_held_out_labels(spark):
    """Fitted on half of the labels: of the other half hardly a good text goes, and most of the bad ones do."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    bands = quality.fit(docs, labels.filter("doc_id % 2 = 0"))
    scored = quality.score(docs, bands=bands).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed")
    counts = {(r.quality, r.kept): r["count"] for r in scored.groupBy("quality", "kept").count().collect()}
    lost = counts.get((1, False), 0) / (counts[1, True] + counts.get((1, False), 0))
    caught = counts[0, False] / (counts[0, False] + counts.get((0, True), 0))
    print(f"good texts lost {lost:.4f}, bad texts caught {caught:.3f}")
    assert lost < 0.01 and caught > 0.6
    assert quality.score(docs).filter("kept = base_failed").count() == 0 < scored.filter("kept = base_failed").count()


def _short_text(rng):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 9))) for _ in range(rng.randint(55, 70)))


def _all_measured(texts):
    """(bytes, ratio) of the texts that the base rule keeps, one by one."""
    one = quality.scorer()
    return [(q[10], q[7]) for q in map(one, texts) if not q[5]]


def test_all_labels_are_fitted_on(spark):
    """Bands of thousands of labelled texts are those of all of them by definition, not of some."""
    rng = random.Random(7)
    texts = [_short_text(rng) for _ in range(7000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    labels = docs.select("doc_id", (docs.doc_id % 50 > 0).cast("int").alias("quality"))
    good = _all_measured(text for k, text in enumerate(texts) if k % 50)
    assert len(good) > 6800 and quality.fit(docs, labels) == quality.limits(good) != quality.limits(good[:6000])


def test_texts_of_one_measurement_all_count(spark):
    """Copies under many ids weigh as many texts; a row or a label that repeats, null ids and other ids don't."""
    rng = random.Random(8)
    common = _short_text(rng)
    texts = [common] * 1200 + [common[:-20] + "x" * 20] + [_short_text(rng) for _ in range(30)]
    rows = [*enumerate(texts), (None, "w " * 60 + _short_text(rng)), (-1, _short_text(rng))]
    docs = spark.createDataFrame([*rows, *rows[1200:]], "doc_id long, text string")
    labels = [(k, 1) for k, _ in rows if k is None or k >= 0] * 2 + [(0, 0), (2**40, 1), (-1, None)]
    found = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    measured = _all_measured(texts)
    assert found == quality.limits(measured) != quality.limits(list(set(measured)))


def test_few_and_no_texts_keep_the_fixed_bands(spark):
    texts = [_short_text(random.Random(k)) for k in range(quality.FEW - 1)]
    docs = spark.createDataFrame([*enumerate(texts), (100, ""), (101, None)], "doc_id long, text string")
    labels = docs.selectExpr("cast(doc_id as int) as doc_id", "1 as quality")
    assert quality.fit(docs, labels) == quality.BANDS
    twenty = docs.union(spark.createDataFrame([(200, texts[0])], docs.schema))
    assert quality.fit(twenty, labels.union(spark.sql("select 200, 1"))) == quality.limits(_all_measured([*texts, texts[0]]))
