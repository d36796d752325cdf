"""Scoring of a text column with a model supplied by the caller.

This is the one place where rows reach Python. The model is made once per task
and fed pieces of Arrow batches of the text column alone, so that its memory does not
grow with the batches; all other columns stay in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Scorer = Callable[[pd.Series], pd.Series]

#: Characters that a model is given at a time; a longer text goes alone.
PIECE_CHARS = 1 << 18


def pieces(batch: pd.Series, chars: int = PIECE_CHARS) -> Iterator[pd.Series]:
    """The texts of a batch in order, in runs of at most ``chars`` characters or of one text."""
    start, held = 0, 0
    for at, size in enumerate(len(text) if isinstance(text, str) else 0 for text in batch):
        if at > start and held + size > chars:
            yield batch.iloc[start:at].reset_index(drop=True)
            start, held = at, 0
        held += size
    yield batch.iloc[start:].reset_index(drop=True)


def score_text(text: Column, make_scorer: Callable[[], Scorer], result_type: str = "string") -> Column:
    """``make_scorer`` must be picklable; it is called on the executors and
    returns a function from a batch of texts to a batch of results. A batch that
    Arrow brings is given to it in :func:`pieces`."""

    # Not annotated as strings: pandas_udf reads the hints to pick the iterator form.
    def run(batches):
        scorer = make_scorer()
        for batch in batches:
            yield pd.concat([pd.Series(scorer(piece)) for piece in pieces(batch)], ignore_index=True)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, result_type)(text)
