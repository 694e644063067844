"""Date helpers (D1-D7), native Spark expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from rxlens.functions.strings import col_

# The text formats of the extracts.
LONG_DATE = "MMMM d, yyyy"     # "April 7, 2024" / "April 07, 2024"
SHORT_DATE = "M/d/yyyy"        # "4/7/2024"


def parse_long_date(c: str | Column) -> Column:
    """``April 07, 2024`` → date; empty text is null."""
    c = col_(c)
    return F.to_date(F.nullif(c, F.lit("")), LONG_DATE)


def parse_short_date(c: str | Column) -> Column:
    """D3: ``4/7/2024`` → date; empty text is null."""
    c = col_(c)
    return F.to_date(F.nullif(c, F.lit("")), SHORT_DATE)


def format_long_date(c: str | Column, padded: bool = True) -> Column:
    return F.date_format(col_(c), "MMMM dd, yyyy" if padded else LONG_DATE)


def format_short_date(c: str | Column) -> Column:
    return F.date_format(col_(c), SHORT_DATE)


def lit_date(d: dt.date) -> Column:
    return F.lit(d).cast("date")


def shift_days(c: str | Column, n: int | Column) -> Column:
    """Date plus ``n`` days (``n`` may be a column)."""
    return F.date_add(col_(c), n if isinstance(n, Column) else F.lit(int(n)))


def previous_month_start(c: str | Column) -> Column:
    """First day of the month before ``c``."""
    return F.trunc(F.add_months(col_(c), -1), "MM")


def previous_month_end(c: str | Column) -> Column:
    """Last day of the month before ``c``."""
    return F.last_day(F.add_months(col_(c), -1))


def month_name(c: str | Column) -> Column:
    """Lower-case English month name."""
    return F.lower(F.date_format(col_(c), "MMMM"))


def today_in_zone(instant: str | Column, tz: str) -> Column:
    """The calendar date of an instant (in the session zone) as seen in zone ``tz``."""
    return F.to_date(F.from_utc_timestamp(col_(instant), tz))
