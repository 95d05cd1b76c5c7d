"""Date helpers.

All are column expressions; R's ``wday`` and Spark's ``dayofweek`` share the
numbering Sunday = 1.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .nulls import _c

# --- fixed values -------------------------------------------------------------
SCHOOL_YEAR_START_MONTH = 7      # school years start in July
FOLD_YEAR = 2020                 # months Jan-Jun fold onto this year, Jul-Dec onto the one before
# ------------------------------------------------------------------------------


def nearest_monday(period: str | Column) -> Column:
    """``period + 2 - wday(period) %% 7`` — the Monday closest to the 1st."""
    p = _c(period)
    return F.date_add(p, 2 - (F.dayofweek(p) % 7))


def third_friday(month_start: str | Column) -> Column:
    """C4: ``m + 20 - wday(m) %% 7`` — the third Friday of the month starting at ``m``."""
    m = _c(month_start)
    return F.date_add(m, 20 - (F.dayofweek(m) % 7))


def long_date(col: str | Column, pad_day: bool = False) -> Column:
    """F16: ``%B %e, %Y`` (squished) or ``%B %d, %Y``."""
    return F.date_format(_c(col), "MMMM dd, yyyy" if pad_day else "MMMM d, yyyy")


def us_date(col: str | Column) -> Column:
    """F16: ``%m/%d/%Y``."""
    return F.date_format(_c(col), "MM/dd/yyyy")


def month_year(col: str | Column) -> Column:
    """F16: ``%B %Y``."""
    return F.date_format(_c(col), "MMMM yyyy")


def weeks_inclusive(start: str | Column, end: str | Column) -> Column:
    """``(end - start + 1) / 7`` as a double."""
    return (F.datediff(_c(end), _c(start)) + 1) / F.lit(7.0)


def school_year(col: str | Column, start_month: int = SCHOOL_YEAR_START_MONTH) -> Column:
    """``"Y-(Y+1)"`` for the school year containing the date; NULL date -> NULL.

    (The notebook prints ``nan-nan`` for a missing date; we keep NULL.)
    """
    d = _c(col)
    y = F.year(d) - (F.month(d) < start_month).cast("int")
    return F.concat(y.cast("string"), F.lit("-"), (y + 1).cast("string"))


def fold_month(col: str | Column, fold_year: int = FOLD_YEAR,
               start_month: int = SCHOOL_YEAR_START_MONTH) -> Column:
    """the 1st of the same month on one axis year (Jul-Dec -> fold_year-1)."""
    d = _c(col)
    m = F.month(d)
    y = F.when(m < start_month, F.lit(fold_year)).otherwise(F.lit(fold_year - 1))
    return F.when(d.isNotNull(), F.make_date(y, m, F.lit(1)))


def month_start(col: str | Column) -> Column:
    """month truncation as a DATE."""
    return F.trunc(F.to_date(_c(col)), "month")


def _second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """``end - start`` in whole seconds (BIGINT), independent of the session time zone.

    Built from calendar-day and second-of-day differences, so wall-clock
    (``timestamp_ntz``) values never pass through a zone conversion (a DST
    change would otherwise shift the difference by an hour).
    """
    s, e = _c(start), _c(end)
    days = F.datediff(F.to_date(e), F.to_date(s)).cast("bigint")
    return (days * 86400 + (_second_of_day(e) - _second_of_day(s))).cast("bigint")


def whole_days(seconds: str | Column) -> Column:
    """pandas ``.dt.days``: floor of the day count (negative durations round down)."""
    return F.floor(_c(seconds) / F.lit(86400)).cast("bigint")
