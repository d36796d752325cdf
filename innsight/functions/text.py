"""Text columns: tags, words, combined reviews and model output."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the digit run taken out of "731 days".
DIGITS = r"(\d+)"


def first_integer(text: Column) -> Column:
    return F.regexp_extract(text, DIGITS, 1).try_cast("int")


def parse_tags(text: Column) -> Column:
    """``"[' Solo ', ' Leisure trip ']"`` to ``["Solo", "Leisure trip"]``."""
    parts = F.split(F.regexp_replace(text, r"[\[\]']", ""), ", ")
    return F.transform(parts, lambda part: F.trim(part))


def tidy(text: Column) -> Column:
    return F.lower(F.trim(text))


def or_default(text: Column, default: str) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def words(text: Column) -> Column:
    """Whitespace-separated words; blanks at either end leave empty strings."""
    return F.split(text, r"\s+")


def strip_punctuation(word: Column) -> Column:
    return F.btrim(word, F.lit(string.punctuation))


def combined_review(positive: Column, negative: Column) -> Column:
    return F.concat(F.coalesce(positive, F.lit("")), F.lit(". "), F.coalesce(negative, F.lit("")))


def digest_line(positive: Column, negative: Column) -> Column:
    # Fixed format.
    return F.concat(F.lit("Positiva: "), positive, F.lit(" | Negativa: "), negative, F.lit(". "))


def summary_prompt(reviews: Column) -> Column:
    # Fixed format.
    return F.concat(
        F.lit(
            "Give me a detailed and elegant summary of the following reviews "
            "(Return only the summary itself):\n"
        ),
        reviews,
    )


def label_prompt(review: Column) -> Column:
    # Fixed value: the instruction to the model.
    instruction = "Classify the overall sentiment of this hotel review (positive, neutral, or negative):"
    return F.concat(F.lit(instruction + "\n"), review)


def strip_reasoning(output: Column) -> Column:
    """Model output without its ``<think>...</think>`` blocks and outer whitespace."""
    visible = F.regexp_replace(output, r"(?s)<think>.*?</think>", "")
    return F.regexp_replace(visible, r"^\s+|\s+$", "")


def parse_label(output: Column) -> Column:
    """Free-text verdict of a model to 1, 0 or -1; "positive" wins, unclear is 0."""
    said = F.lower(output)
    return (
        F.when(said.contains("positive"), 1)
        .when(said.contains("neutral"), 0)
        .when(said.contains("negative"), -1)
        .otherwise(0)
    )
