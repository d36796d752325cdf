"""From raw strings to the cleaned review table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.functions import text
from innsight.functions.address import with_place
from innsight.operators.dedup import drop_copies
from innsight.schema import CLEAN, DOUBLE_COLUMNS, IMPUTED, INT_COLUMNS, RAW_COLUMNS, REQUIRED_COLUMNS

REVIEW_ID = "Review_Id"


def typed(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Give every column its type; what cannot be read becomes null. Columns to ``keep`` stay as they are.

    One projection with ``try_`` casts only: under ANSI mode a plain cast of
    ``"NA"`` would end the job.
    """
    by_name = {name: F.col(name).try_cast("int") for name in INT_COLUMNS}
    by_name |= {name: F.col(name).try_cast("double") for name in DOUBLE_COLUMNS}
    by_name["Review_Date"] = F.try_to_date(F.col("Review_Date"), "M/d/yyyy")
    by_name["days_since_review"] = text.first_integer(F.col("days_since_review"))
    by_name["Tags"] = text.parse_tags(F.col("Tags"))
    return with_place(raw.select(*[by_name.get(name, F.col(name)).alias(name) for name in [*RAW_COLUMNS, *keep]]))


def clean(typed_reviews: DataFrame, with_id: bool = False, place: Sequence[str] | None = None) -> DataFrame:
    """Drop unusable rows and copies, tidy the texts, fill the gaps.

    Copies are dropped before the texts are tidied, so rows that become equal
    by trimming stay apart. ``with_id`` adds a 128-bit key of the row as it was
    before tidying, unique since no two such rows are equal. ``place`` names columns
    that tell rows apart (:func:`innsight.sources.reviews.read_raw_stored` gives
    them): then copies are found by digest and place, and texts are not shuffled.
    """
    # Nation and city follow from the address: left out of the copy check to keep
    # its shuffle narrow, and worked out for the rows that remain.
    usable = typed_reviews.select(*RAW_COLUMNS, *(place or ())).na.drop(subset=[*REQUIRED_COLUMNS, "lat", "lng"])
    distinct = usable.dropDuplicates() if place is None else drop_copies(usable, RAW_COLUMNS, place)
    tidied = {
        name: text.or_default(text.tidy(F.col(name)), default) for name, default in IMPUTED.items()
    }
    columns = list(CLEAN.fieldNames())
    if with_id:
        distinct = distinct.withColumn(REVIEW_ID, F.md5(F.to_json(F.struct(*RAW_COLUMNS))))
        columns.append(REVIEW_ID)
    return with_place(distinct.withColumns(tidied)).select(*columns)
