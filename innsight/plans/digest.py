"""Texts handed to a summarising model, one per hotel."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.functions.text import digest_line, strip_reasoning, summary_prompt
from innsight.operators.late import top_n_late
from innsight.operators.scoring import Scorer, score_text
from innsight.operators.skew import HOT_ROWS, hot_keys, top_n
from innsight.plans.common import only
from innsight.schema import IMPUTED, SITE_BLANKS

REVIEWS_PER_DIGEST = 50


def _has_text(column: str) -> Column:
    empty = {SITE_BLANKS[column].lower(), IMPUTED[column].lower()}
    return ~F.lower(column).isin(*sorted(empty))


def review_digest(
    reviews: DataFrame,
    limit: int = REVIEWS_PER_DIGEST,
    hotel: str | None = None,
    hot_rows: int | None = HOT_ROWS,
    id_column: str | None = None,
) -> DataFrame:
    """Up to ``limit`` two-sided reviews of each hotel as one prompt.

    Reviewers with the fewest reviews come first, then the texts in order. A
    hotel without a two-sided review has no row. With ``id_column``, a unique key of
    the rows, reviews are ranked by their reviewers alone, and texts are read where
    that leaves them chosen or tied with the last one chosen.
    """
    texts = list(SITE_BLANKS)
    activity = "Total_Number_of_Reviews_Reviewer_Has_Given"
    chosen = only(reviews, "Hotel_Name", hotel)
    two_sided = chosen.filter(reduce(and_, [_has_text(name) for name in texts]))
    order = [activity, *texts]
    if id_column is None:
        # Counted over all reviews, so that the count reads no text.
        hot = None if hot_rows is None else hot_keys(chosen, ["Hotel_Name"], hot_rows)
        ranked = two_sided.select("Hotel_Name", *order)
        first = top_n(ranked, ["Hotel_Name"], [F.asc(name) for name in order], limit, hot=hot)
    else:
        first = top_n_late(two_sided, ["Hotel_Name"], order, limit, id_column, texts, hot_rows=hot_rows)
    line = digest_line(*[F.col(name) for name in texts]).alias("line")
    # At most ``limit`` lines per hotel are collected.
    return (
        first.groupBy("Hotel_Name")
        .agg(F.array_sort(F.collect_list(F.struct("rank", line))).alias("_lines"))
        .select(
            "Hotel_Name",
            F.size("_lines").alias("num_reviews"),
            summary_prompt(F.array_join("_lines.line", "")).alias("prompt"),
        )
    )


def hotel_summaries(digests: DataFrame, make_model: Callable[[], Scorer]) -> DataFrame:
    """What a text model supplied by the caller answers to each prompt, without its reasoning."""
    answer = score_text(F.col("prompt"), make_model)
    return digests.select("Hotel_Name", "num_reviews", strip_reasoning(answer).alias("summary"))
