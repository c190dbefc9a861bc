"""Date parsing, formatting and windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date masks used on the wire and in reports.
DAY_MONTH_YEAR = "dd-MM-yyyy"
DAY_MON_YEAR = "dd-MMM-yyyy"
LOOKBACK_MONTHS = 2


def parse_day_month_year(text: Column) -> Column:
    """``31-12-2024`` to a date; text that is no such date becomes null."""
    return F.try_to_date(text, DAY_MONTH_YEAR)


def day_month_year(date: Column) -> Column:
    return F.date_format(date, DAY_MONTH_YEAR)


def day_mon_year(date: Column) -> Column:
    """``31-DEC-2024``."""
    return F.upper(F.date_format(date, DAY_MON_YEAR))


def lookback_start(as_of: Column) -> Column:
    """Start of the first load, when the ledger holds nothing yet."""
    return F.add_months(as_of, -LOOKBACK_MONTHS)


def on_or_after(column: Column, day: dt.date) -> Column:
    """``trunc(column) >= day`` with the column left bare, so that it pushes down."""
    return column >= F.lit(day)


def in_closed_window(column: Column, first: dt.date, last: dt.date) -> Column:
    """Whole days ``first`` to ``last``, both included."""
    return (column >= F.lit(first)) & (column < F.lit(last + dt.timedelta(days=1)))


def in_open_window(column: Column, after: dt.date, before: dt.date) -> Column:
    """Days strictly between ``after`` and ``before``."""
    return (column >= F.lit(after + dt.timedelta(days=1))) & (column < F.lit(before))


def on_day(column: Column, day: dt.date) -> Column:
    return in_closed_window(column, day, day)
