"""Date parsing and date parts."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_day(as_of: datetime.date | str | None) -> Column:
    """The day a run stands for; today unless pinned."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def parse_date(text: Column) -> Column:
    """ISO date; anything else becomes NULL instead of failing the job."""
    return F.try_to_date(text, "yyyy-MM-dd")


def date_parts(day: Column) -> dict[str, Column]:
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.date_format(day, "MMMM"),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": F.date_format(day, "EEEE"),
    }


def in_last_year(day: Column, as_of: datetime.date | str | None = None) -> Column:
    """Rolling window: the run day and the 365 days before it."""
    return day.between(F.date_sub(run_day(as_of), 365), run_day(as_of))
