"""Review tables derived from the given tables.

``reviews``: a supplier is a hotel, a line item is a review. Foreign keys of the
given tables are complete, so a dimension is joined only when a column of it is
asked for; the rows are the same either way.

``text_reviews``: a document is a review. Its first line is the positive part,
the rest of it the negative part, so each text is used whole.

``raw_reviews``: line items written the way the raw files are: strings only,
with junk, gaps and copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innsight.functions.text import or_default, parse_tags, tidy
from innsight.schema import IMPUTED

#: A hotel chain, a city and a nation of the derived tables, for the questions about one.
ONE_HOTEL, ONE_CITY, ONE_NATION = "Chain 0", "NATION_7", "en"
LEXICON = {"and": 1.5, "that": -0.5, "with": 2.0, "the": -0.25, "was": -2.0, "from": 0.75}
PARTS_OF_SPEECH = {"and": "r", "that": "a", "with": "a", "the": "n", "was": "v", "from": "r"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lexicon(spark: SparkSession) -> DataFrame:
    rows = ", ".join(
        f"('{word}', {valence}D, '{PARTS_OF_SPEECH[word]}')" for word, valence in LEXICON.items()
    )
    return spark.sql(f"select * from values {rows} as lexicon(word, valence, pos)")


def untidy_lexicon(spark: SparkSession) -> DataFrame:
    """The lexicon with a word listed twice and one in capitals."""
    known = lexicon(spark)
    again = known.filter("word = 'that'").unionByName(known.filter("word = 'with'").withColumn("word", F.upper("word")))
    return known.filter("word <> 'with'").unionByName(again)


_OF_HOTEL = {
    # Two suppliers in ten are the two sites of a chain.
    "Hotel_Name": "if(s_suppkey % 5 = 0, concat('Chain ', s_suppkey div 10), s_name)",
    "Hotel_City": "hn_name",
    "Hotel_Nationality": "r_name",
    "Hotel_Address": "concat(cast(s_suppkey as string), ' Main Street ', hn_name, ' ', r_name)",
    "lat": "40D + s_nationkey / 2D + ((s_suppkey * 37) % 64 - 32) / 1024D",
    "lng": "5D + s_nationkey / 4D + ((s_suppkey * 53) % 64 - 32) / 1024D",
    "Average_Score": "8D + (s_suppkey % 16) / 16D",
}
_OF_REVIEW = {
    "Review_Date": "cast(l_shipdate as date)",
    "Reviewer_Score": "10D - l_quantity * l_quantity / 256D",
    "Positive_Review": "concat('flag ', lower(l_returnflag), ' and status ', lower(l_linestatus))",
    "Negative_Review": "concat('line ', l_linenumber, ' of order ', l_orderkey)",
}
_OF_ORDER = {"Total_Number_of_Reviews_Reviewer_Has_Given": "cast(o_custkey % 40 + 1 as int)"}
_OF_REVIEWER = {"Reviewer_Nationality": "if(o_custkey % 9 = 4, 'Unknown', rn_name)"}
_OF_ORDER_AND_PART = {
    "Tags": "concat('['' ', o_orderpriority, ' '', '' ', p_type, ' '', '' ', l_returnflag, ' '']')"
}


def _join_dimensions(spark: SparkSession, sf_dir: str, wanted: set[str]) -> DataFrame:
    def table_of(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    star = table_of("lineitem")
    if wanted & _OF_HOTEL.keys():
        hotels = table_of("supplier").drop("s_acctbal")
        if wanted & {"Hotel_City", "Hotel_Nationality", "Hotel_Address"}:
            places = (
                table_of("nation")
                .withColumnsRenamed({"n_nationkey": "hn_nationkey", "n_name": "hn_name"})
                .join(table_of("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            )
            hotels = hotels.join(places, F.col("s_nationkey") == F.col("hn_nationkey"))
        star = star.join(hotels, F.col("l_suppkey") == F.col("s_suppkey"))
    if wanted & (_OF_ORDER | _OF_REVIEWER | _OF_ORDER_AND_PART).keys():
        orders = table_of("orders")
        # Orders meet their reviewers first, and nations come last: line items are shuffled once for both tables, without names.
        if wanted & _OF_REVIEWER.keys():
            orders = orders.join(table_of("customer"), F.col("o_custkey") == F.col("c_custkey"))
        star = star.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if wanted & _OF_ORDER_AND_PART.keys():
        star = star.join(table_of("part"), F.col("l_partkey") == F.col("p_partkey"))
    if wanted & _OF_REVIEWER.keys():
        nations = table_of("nation").select(
            F.col("n_nationkey").alias("rn_nationkey"), F.col("n_name").alias("rn_name")
        )
        star = star.join(nations, F.col("c_nationkey") == F.col("rn_nationkey"))
    return star


def reviews(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    star = _join_dimensions(spark, sf_dir, set(columns))
    formulas = _OF_HOTEL | _OF_REVIEW | _OF_ORDER | _OF_REVIEWER | _OF_ORDER_AND_PART
    derived = star.select(*[F.expr(formulas[name]).alias(name) for name in columns])
    return derived.withColumn("Tags", parse_tags(F.col("Tags"))) if "Tags" in columns else derived


def text_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    end = F.instr("text", "\n")
    whole = F.col("text")
    positive = F.when(end > 0, F.substr(whole, F.lit(1), end - 1)).otherwise(whole)
    negative = F.when(end > 0, F.substr(whole, end + 1)).otherwise("")
    return documents.select(
        F.col("doc_id").alias("review_id"),
        F.col("source").alias("Hotel_Name"),
        F.concat(F.lit("City of "), F.col("lang")).alias("Hotel_City"),
        # The same nation in two spellings.
        F.when(F.col("doc_id") % 3 == 0, F.initcap("lang")).otherwise(F.col("lang")).alias("Hotel_Nationality"),
        F.concat(F.lit("1 Text Street "), F.col("source")).alias("Hotel_Address"),
        F.date_add(F.lit("2015-01-01").cast("date"), (F.col("doc_id") % 1096).cast("int")).alias("Review_Date"),
        F.expr("1D + (n_chars % 145) / 16D").alias("Reviewer_Score"),
        (F.col("doc_id") % 40 + 1).cast("int").alias("Total_Number_of_Reviews_Reviewer_Has_Given"),
        or_default(tidy(positive), IMPUTED["Positive_Review"]).alias("Positive_Review"),
        or_default(tidy(negative), IMPUTED["Negative_Review"]).alias("Negative_Review"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = {"Hotel_Name", "Reviewer_Nationality", "Tags"}
    star = _join_dimensions(spark, sf_dir, needed)
    address = """
        case s_suppkey % 8
          when 0 then concat(s_suppkey, ' Low Road London NW1 6XE United Kingdom')
          when 1 then concat(s_suppkey, ' High Street London Mayfair Park W1K 6BD United Kingdom')
          when 2 then concat(s_suppkey, ' Long Lane  Leeds LS1 4AP United  Kingdom ')
          when 3 then concat(s_suppkey, ' Via Roma Milan Italy')
          when 4 then concat(s_suppkey, ' Rue de France Paris France')
          when 5 then concat('no nation ', s_suppkey)
          when 6 then 'Spain'
        end"""
    strings = {
        "Hotel_Address": address,
        "Additional_Number_of_Scoring": "if(l_partkey % 101 = 7, '', cast(l_partkey as string))",
        "Review_Date": "if(l_partkey % 97 = 5, '2017-13-40', date_format(l_shipdate, 'M/d/yyyy'))",
        "Average_Score": "cast(8D + (s_suppkey % 16) / 16D as string)",
        "Hotel_Name": "s_name",
        "Reviewer_Nationality": "if(c_nationkey % 9 = 4, ' ', concat(' ', rn_name, ' '))",
        "Negative_Review": """case l_returnflag when 'A' then ' No Negative ' when 'R' then ''
                              else concat(' ', o_orderpriority, ' ') end""",
        "Review_Total_Negative_Word_Counts": "cast(l_linenumber as string)",
        "Total_Number_of_Reviews": "cast(s_suppkey + 1000 as string)",
        "Positive_Review": """case l_linenumber when 1 then '   ' when 2 then null
                              else concat(' ', p_name, ' WITH ', p_type, ' ') end""",
        "Review_Total_Positive_Word_Counts": "cast(l_linenumber + 2 as string)",
        "Total_Number_of_Reviews_Reviewer_Has_Given": "cast(o_custkey % 40 + 1 as string)",
        "Reviewer_Score": "cast(10D - l_quantity * l_quantity / 256D as string)",
        "Tags": _OF_ORDER_AND_PART["Tags"],
        "days_since_review": "if(l_partkey % 89 = 3, 'n/a', concat(l_orderkey % 900, ' days'))",
        "lat": "if(s_suppkey % 17 = 3, 'NA', cast(" + _OF_HOTEL["lat"] + " as string))",
        "lng": "if(s_suppkey % 17 = 3, 'NA', cast(" + _OF_HOTEL["lng"] + " as string))",
    }
    written_twice = star.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.when(F.col("l_linenumber") == 3, 2).otherwise(1)))
    )
    return written_twice.select(*[F.expr(sql).alias(name) for name, sql in strings.items()])


def benchmark_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each word of the benchmark once, as an adverb if its length is even, else a noun."""
    word = F.explode(F.split(F.lower("text"), r"\s+")).alias("word")
    return (
        table(spark, sf_dir, "benchmark")
        .select(word)
        .filter(F.col("word") != "")
        .distinct()
        .withColumn("pos", F.when(F.length("word") % 2 == 0, "r").otherwise("n"))
    )


def sights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sight per nation, in the middle of its hotels."""
    return table(spark, sf_dir, "nation").selectExpr(
        "n_name as city",
        "concat('Sight of ', n_name) as nome",
        "40D + n_nationkey / 2D as lat",
        "5D + n_nationkey / 4D as lng",
    )


def centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City centres, every other one known under another name than in the addresses."""
    return table(spark, sf_dir, "nation").selectExpr(
        "if(n_regionkey = 0, concat('CITTA_', n_nationkey), n_name) as city",
        "n_name as alias",
        "40D + n_nationkey / 2D as lat",
        "5D + n_nationkey / 4D as lng",
    )


def outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of outlined nations, in capitals, one of them without reviews."""
    langs = table(spark, sf_dir, "documents").select(F.upper("lang").alias("name")).distinct()
    others = table(spark, sf_dir, "region").select(F.col("r_name").alias("name"))
    return langs.unionByName(others)
