"""Nation and city of a hotel, read off its postal address.

The last word of an address is the nation ("United Kingdom" counts as one
word). The city is the word just before the nation, except for British
addresses, where a postcode of two words stands in between.

An address without a recognisable nation, or too short to hold a city, gives
null instead of failing the job. Runs of blanks are collapsed first, so a
doubled blank neither hides "United Kingdom" nor shifts the word positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
NATION_PATTERN = r"(United\s+Kingdom|\b[A-Z][a-z]+)$"
UNITED_KINGDOM = "United Kingdom"
UK_WORDS_AFTER_CITY = 4
UK_LONG_POSTCODE = "6BD"
UK_WORDS_AFTER_CITY_LONG = 6


def normalised(address: Column) -> Column:
    return F.trim(F.regexp_replace(address, r"\s+", " "))


def nation(tidy_address: Column) -> Column:
    return F.nullif(F.regexp_extract(tidy_address, NATION_PATTERN, 1), F.lit(""))


def city(words: Column, nation: Column) -> Column:
    behind = F.when(
        F.array_contains(words, UK_LONG_POSTCODE), UK_WORDS_AFTER_CITY_LONG
    ).otherwise(UK_WORDS_AFTER_CITY)
    # array_position is 1-based and gives 0 for a word that is not there.
    position = F.when(
        nation == UNITED_KINGDOM, F.array_position(words, "Kingdom") - behind
    ).otherwise(F.array_position(words, nation) - 1)
    return F.when(position > 0, F.try_element_at(words, position.cast("int")))


def with_place(df: DataFrame, address: str = "Hotel_Address") -> DataFrame:
    """Add ``Hotel_Nationality`` and ``Hotel_City``.

    In steps, so that each address is tidied, matched and split once per row.
    """
    return (
        df.withColumn("_address", normalised(F.col(address)))
        .withColumns({"Hotel_Nationality": nation(F.col("_address")), "_words": F.split("_address", " ")})
        .withColumn("Hotel_City", city(F.col("_words"), F.col("Hotel_Nationality")))
        .drop("_address", "_words")
    )
