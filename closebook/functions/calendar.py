"""Date spine and calendar attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.functions import columns as C

_STEP = {
    "day": "INTERVAL 1 DAY",
    "week": "INTERVAL 7 DAYS",
    "month": "INTERVAL 1 MONTH",
    "quarter": "INTERVAL 3 MONTHS",
    "year": "INTERVAL 1 YEAR",
}


def calendar_columns(d: Column | str) -> list[Column]:
    """The attribute columns of a calendar row for date ``d``."""
    d = C.col_(d)
    return [
        C.month_of(d).alias("month"),
        C.quarter_of(d).alias("quarter"),
        C.year_of(d).alias("year"),
        C.day_of_week(d).alias("day_of_week"),
        C.week_of_year(d).alias("week_of_year"),
        F.dayofyear(d).alias("day_of_year"),
        C.day_name(d).alias("day_name"),
        C.is_weekday(d).alias("is_weekday"),
    ]


def date_spine(bounds: DataFrame, start_col: str = "start_date",
               end_col: str = "end_date", datepart: str = "day",
               keep: Sequence[str] = ()) -> DataFrame:
    """One row per ``datepart`` step from start (inclusive) to end (exclusive).

    ``bounds`` carries one row per spine (usually a one-row aggregate such as
    min/max of a date column), so the spine follows the data instead of fixed
    literals. The spine length is bounded by the calendar range, not by the
    table size. The date column is always called ``date``. ``keep`` names columns
    of ``bounds`` that tell several spines apart.
    """
    if datepart not in _STEP:
        raise ValueError(f"unsupported datepart {datepart!r}")
    step = F.expr(_STEP[datepart])
    start, end = F.col(start_col), F.col(end_col)
    # sequence() is inclusive; drop the end point to make the range half-open.
    days = F.filter(F.sequence(start, end, step), lambda x: x < end)
    spine = bounds.where(start < end).select(*keep, F.explode(days).alias("date"))
    return spine.select(*keep, "date", *calendar_columns("date"))
