"""Date columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SEASON_MONTHS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Autumn": (9, 10, 11),
}
NO_SEASON = "Unknown"


def season(date: Column) -> Column:
    chosen = None
    for name, months in SEASON_MONTHS.items():
        in_season = F.month(date).isin(*months)
        chosen = F.when(in_season, name) if chosen is None else chosen.when(in_season, name)
    return chosen.otherwise(NO_SEASON)


def year_month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")
