"""Schemas of the raw and the cleaned review table.

Raw files are read as strings under a declared schema, so no pass over the
data is spent on type inference; types are given by :func:`innsight.plans.ingest.typed`.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of the raw files.
RAW_COLUMNS = [
    "Hotel_Address",
    "Additional_Number_of_Scoring",
    "Review_Date",
    "Average_Score",
    "Hotel_Name",
    "Reviewer_Nationality",
    "Negative_Review",
    "Review_Total_Negative_Word_Counts",
    "Total_Number_of_Reviews",
    "Positive_Review",
    "Review_Total_Positive_Word_Counts",
    "Total_Number_of_Reviews_Reviewer_Has_Given",
    "Reviewer_Score",
    "Tags",
    "days_since_review",
    "lat",
    "lng",
]

RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

INT_COLUMNS = [
    "Additional_Number_of_Scoring",
    "Review_Total_Negative_Word_Counts",
    "Total_Number_of_Reviews",
    "Review_Total_Positive_Word_Counts",
    "Total_Number_of_Reviews_Reviewer_Has_Given",
]

DOUBLE_COLUMNS = ["Average_Score", "Reviewer_Score", "lat", "lng"]

# A row with a null in any of these is dropped by the cleaning step.
REQUIRED_COLUMNS = [
    "Additional_Number_of_Scoring",
    "Review_Date",
    "Average_Score",
    "Hotel_Name",
    "Review_Total_Negative_Word_Counts",
    "Total_Number_of_Reviews",
    "Review_Total_Positive_Word_Counts",
    "Total_Number_of_Reviews_Reviewer_Has_Given",
    "Reviewer_Score",
    "Tags",
    "days_since_review",
]

# Text put in place of a missing or blank value.
IMPUTED = {
    "Positive_Review": "No positive comment",
    "Negative_Review": "No negative comment",
    "Reviewer_Nationality": "Unknown",
}

# What the review site itself writes when a part was left empty.
SITE_BLANKS = {
    "Positive_Review": "No Positive",
    "Negative_Review": "No Negative",
}


def _clean_type(name: str) -> T.DataType:
    if name in INT_COLUMNS or name == "days_since_review":
        return T.IntegerType()
    if name in DOUBLE_COLUMNS:
        return T.DoubleType()
    if name == "Review_Date":
        return T.DateType()
    if name == "Tags":
        return T.ArrayType(T.StringType())
    return T.StringType()


CLEAN = T.StructType(
    [T.StructField(name, _clean_type(name)) for name in RAW_COLUMNS]
    + [T.StructField(name, T.StringType()) for name in ("Hotel_Nationality", "Hotel_City")]
)
