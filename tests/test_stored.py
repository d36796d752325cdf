"""Stored forms: buckets by hotel, dates from footers, sketches, files whose columns differ in order."""

import csv
import datetime
import random
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from innsight.operators import dedup, distinct
from innsight.plans import hotels, ingest, nearby, places
from innsight.schema import RAW_COLUMNS
from innsight.sources import reviews as source
from workload import views

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = (
    "Hotel_Name", "Hotel_City", "Hotel_Nationality", "Hotel_Address", "lat", "lng", "Average_Score", "Review_Date",
    "Reviewer_Score", "Reviewer_Nationality", "Positive_Review", "Negative_Review",
)


@pytest.fixture(scope="module")
def reviews(spark):
    return views.reviews(spark, SF_DIR, *COLUMNS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def bucketed(spark, reviews, tmp_path_factory):
    name = f"reviews_{uuid.uuid4().hex}"
    # One hotel has most of the rows.
    hot = reviews.withColumn("Hotel_Name", F.when(F.col("Review_Date") > "1996-06-01", "Chain 0").otherwise(F.col("Hotel_Name")))
    source.write_bucketed(hot, name, 4, str(tmp_path_factory.mktemp("bucketed") / "table"))
    yield spark.table(name), hot
    spark.sql(f"drop table {name}")


@pytest.mark.parametrize("question", [hotels.mean_score, hotels.monthly_trend, hotels.fact_sheet])
def test_questions_per_hotel_need_no_shuffle_on_buckets(bucketed, question):
    table, plain = bucketed
    assert "Exchange" not in plan(question(table)) and "Exchange" in plan(question(plain))
    assert rows(question(table)) == rows(question(plain))


def test_latest_date_from_footers(spark, reviews, tmp_path):
    path = str(tmp_path / "clean")
    source.write_clean(reviews, path)
    text = plan(source._greatest(spark, path, "Review_Date"))
    assert "PushedAggregation: [MAX(Review_Date)]" in text
    latest = source.latest_date(spark, path)
    assert latest == reviews.agg(F.max("Review_Date")).first()[0]
    table = source.read_clean(spark, path)
    assert "BatchScan" not in plan(table) and spark.conf.get("spark.sql.sources.useV1SourceList") != ""
    dated = hotels.reputation(table, as_of=latest)
    assert plan(dated).split("== Initial Plan ==")[0].count("FileScan") == 1 and "Subquery" not in plan(dated)
    assert rows(dated) == rows(hotels.reputation(table))
    nobody = hotels.reputation(table, as_of=datetime.date(2030, 1, 1)).collect()
    assert {r.andamento for r in nobody} == {"sconosciuta"}
    reviews.limit(0).write.parquet(str(tmp_path / "none"))
    assert source.latest_date(spark, str(tmp_path / "none")) is None


def test_overview_of_sketches(spark, reviews, tmp_path):
    dated = reviews.withColumn("year", F.year("Review_Date"))
    for year in (1995, 1996):
        part = dated.filter(F.col("year") == year) if year == 1995 else dated.filter("year > 1995")
        places.city_sketches(part, "year").write.mode("append").parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    assert rows(places.overview_of_sketches(stored)) == rows(
        places.city_overview(reviews).select("Hotel_City", "Total_Reviews", "Number_Hotel", "Average_Score", "TotalN", "TotalP")
    )


@pytest.mark.parametrize("lg_k", [10, 14])
def test_error_of_merged_sketches(spark, lg_k):
    """Within four standard errors of the exact count, for counts from one to 200,000 over 20 overlapping parts."""
    found = spark.range(400_000).select(
        F.expr("case when id < 200000 then 'all' when id < 250000 then 'some' when id = 250000 then 'one' else 'few' end").alias("city"),
        F.expr("case when id < 250001 then concat('h', id) else concat('h', id % 700) end").alias("hotel"),
        (F.col("id") % 20).alias("day"),
    )
    found = found.union(found.withColumn("day", F.col("day") + 3))
    sketches = found.groupBy("city", "day").agg(distinct.distinct_sketch("hotel", lg_k).alias("s"))
    merged = distinct.merge_sketches(sketches, "s", "city").select("city", distinct.estimate("s").alias("n"))
    exact = {r.city: r.n for r in found.groupBy("city").agg(F.count_distinct("hotel").alias("n")).collect()}
    for row in merged.collect():
        assert abs(row.n - exact[row.city]) <= 4 * distinct.relative_error(lg_k) * exact[row.city]
    assert exact["one"] == 1 and {r.n for r in merged.filter("city = 'one'").collect()} == {1}


def write_csv(path, columns, records):
    with open(path, "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file, quoting=csv.QUOTE_ALL, escapechar="\\", doublequote=False)
        out.writerow(columns)
        out.writerows([[record.get(name, "") for name in columns] for record in records])


def test_files_of_two_orders_give_the_same_rows(spark, tmp_path):
    rng = random.Random(1)
    records = [{name: f"{name[:3]} {k}, é" for name in RAW_COLUMNS} for k in range(30)]
    (tmp_path / "one").mkdir()
    (tmp_path / "many").mkdir()
    write_csv(tmp_path / "one" / "a.csv", RAW_COLUMNS, records)
    for k in range(5):
        columns = [*RAW_COLUMNS, "extra", f"other {k}"][: 17 + k % 3]
        rng.shuffle(columns)
        write_csv(tmp_path / "many" / f"{k}.csv", columns, records[k * 6 : k * 6 + 6])
    expected = rows(source.read_raw(spark, str(tmp_path / "one")))
    many = source.read_raw_any_order(spark, str(tmp_path / "many"))
    assert rows(many) == expected and len(expected) == 30 and many.columns == RAW_COLUMNS
    assert rows(source.read_raw_any_order(spark, str(tmp_path / "one"))) == expected
    write_csv(tmp_path / "many" / "short.csv", RAW_COLUMNS[:-1], records[:1])
    with pytest.raises(PySparkException, match="no header line"):
        source.read_raw_any_order(spark, str(tmp_path / "many")).collect()


@pytest.fixture(scope="module")
def raw_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "stored")
    views.raw_reviews(spark, SF_DIR).repartition(5).write.parquet(path)
    return path


def text_exchanges(node):
    """Whether each shuffle of texts has the bit map's broadcast below it."""
    below = [node.children().apply(k) for k in range(node.children().size())]
    names = {node.output().apply(k).name() for k in range(node.output().size())}
    own = ["_bits" in node.toString()] if node.nodeName() == "Exchange" and "Positive_Review" in names else []
    return own + [found for child in below for found in text_exchanges(child)]


def test_copies_are_dropped_without_a_shuffle_of_texts(spark, raw_path):
    stored = source.read_raw_stored(spark, raw_path)
    by_place = ingest.clean(ingest.typed(stored, source.PLACE), with_id=True, place=source.PLACE)
    by_rows = ingest.clean(ingest.typed(stored), with_id=True)
    assert by_place.schema == by_rows.schema
    assert rows(by_place) == rows(by_rows) and by_rows.count() < stored.count()
    first_plan = by_place._jdf.queryExecution().executedPlan().initialPlan()
    assert all(text_exchanges(first_plan))
    assert not all(text_exchanges(by_rows._jdf.queryExecution().executedPlan().initialPlan()))


def test_drop_copies(spark):
    rng = random.Random(2)
    data = [(k, rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([["x"], [], None])) for k in range(300)]
    data += [(300 + k, "same", 7, ["y"]) for k in range(400)]
    df = spark.createDataFrame(data, "i int, s string, n int, a array<string>")
    got = sorted(r.i for r in dedup.drop_copies(df, ["s", "n", "a"], ["i"]).collect())
    first = {}
    for i, *rest in data:
        first.setdefault(str(rest), i)
    assert got == sorted(first.values())
    assert dedup.drop_copies(df.limit(0), ["s"], ["i"]).count() == 0


def test_names_near_a_point_come_from_a_narrow_scan(spark, reviews, tmp_path):
    reviews.write.parquet(str(tmp_path / "flat"))
    table = spark.read.parquet(str(tmp_path / "flat"))
    near = nearby.hotels_near_point_by_name(table, 45.0, 9.0, 300.0)
    expected = rows(nearby.hotels_near_point(table, 45.0, 9.0, 300.0))
    assert rows(near) == expected and expected
    pushed = [line for line in plan(nearby.hotels_near_point_by_name(table, 45.0, 9.0, 300.0)).splitlines() if "PushedFilters" in line]
    assert any("GreaterThanOrEqual(lat" in line and "LessThanOrEqual(lng" in line and "Reviewer_Score" not in line for line in pushed)
    unnamed = table.withColumn("Hotel_Name", F.when(F.col("lat") > 45, F.col("Hotel_Name")))
    assert rows(nearby.hotels_near_point_by_name(unnamed, 45.0, 9.0, 300.0)) == rows(nearby.hotels_near_point(unnamed, 45.0, 9.0, 300.0))
