"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def frac_year(publication_date: Column | str, year: Column | str) -> Column:
    """Year plus (month - 1) / 12, month read from characters 6-7 of an ISO date.

    A null year counts as 0. When the date is shorter than 7 characters or its
    month is not a number, the result is the year as a double. The month is
    not range checked (13 gives the next year, 00 one twelfth less).
    """
    d = F.col(publication_date) if isinstance(publication_date, str) else publication_date
    y = F.col(year) if isinstance(year, str) else year
    y0 = F.coalesce(y.cast("int"), F.lit(0))
    # the cast raises and catches an error for every text that is no number: too short dates never reach it
    text = F.substring(d, 6, 2)
    month = F.when((F.length(d) >= 7), text).try_cast("int")
    return F.coalesce(y0 + (month - 1) / F.lit(12.0), y0.cast("double"))


def run_date(sync_date: str | None = None) -> Column:
    """``YYYY-MM-DD`` of the run, or the given fixed date (tests)."""
    if sync_date is not None:
        return F.lit(sync_date)
    return F.date_format(F.current_date(), "yyyy-MM-dd")
