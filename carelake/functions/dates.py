"""Date expressions (X18-X21, X28-X31) and calendar windows.

Window helpers are pure functions of the run date: they return literal
bounds, so the resulting predicates are plain range filters on the raw
column and reach the Parquet/JDBC scan as pushed filters.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.functions._col import as_col

__all__ = [
    "age_years", "age_months", "mid_month", "full_months", "day_span",
    "in_range", "in_days", "prev_week", "current_week", "fortnight",
    "prev_month", "lagged_month", "prev_iso_week", "day_window", "last_24h",
    "period_path", "SPANISH_MONTHS", "monday_of", "week_start", "weekday",
]

# Spanish month names used in file and folder names.
SPANISH_MONTHS = (
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
)


def age_years(born, on) -> Column:
    """Completed years; birthday not reached this year subtracts one.

    (Not ``months_between/12``, which differs at month ends.)
    """
    b, o = as_col(born), as_col(on)
    before = (F.month(o) * 100 + F.dayofmonth(o)) < (F.month(b) * 100 + F.dayofmonth(b))
    return (F.year(o) - F.year(b) - before.cast("int")).cast("int")


def age_months(born, on) -> Column:
    """Calendar months, no day adjustment."""
    b, o = as_col(born), as_col(on)
    return ((F.year(o) - F.year(b)) * 12 + F.month(o) - F.month(b)).cast("int")


def mid_month(d) -> Column:
    """The 15th of the value's month (period key)."""
    return F.date_add(F.trunc(as_col(d).cast("date"), "MM"), 14)


def full_months(start, end) -> Column:
    """Whole months elapsed (Jan 31 -> Feb 29 is 0)."""
    return F.timestamp_diff("MONTH", as_col(start).cast("timestamp_ntz"),
                            as_col(end).cast("timestamp_ntz")).cast("int")


def day_span(start, end) -> Column:
    """Whole days of ``end - start`` (floor of elapsed seconds / 86400)."""
    s = F.unix_micros(as_col(start).cast("timestamp"))
    e = F.unix_micros(as_col(end).cast("timestamp"))
    return F.floor((e - s) / F.lit(86_400_000_000)).cast("int")


def _lit_ts(d: dt.date | dt.datetime) -> Column:
    if isinstance(d, dt.datetime):
        return F.lit(d).cast("timestamp_ntz")
    return F.lit(dt.datetime(d.year, d.month, d.day)).cast("timestamp_ntz")


def in_range(c, lo: dt.date | dt.datetime, hi: dt.date | dt.datetime,
             hi_inclusive: bool = False, lo_inclusive: bool = True) -> Column:
    """Range predicate on the raw column (sargable, pushdown-friendly)."""
    col = as_col(c)
    lo_p = col >= _lit_ts(lo) if lo_inclusive else col > _lit_ts(lo)
    hi_p = col <= _lit_ts(hi) if hi_inclusive else col < _lit_ts(hi)
    return lo_p & hi_p


def in_days(c, first: dt.date, last: dt.date) -> Column:
    """Whole calendar days ``first..last`` inclusive as a half-open timestamp range."""
    return in_range(c, first, last + dt.timedelta(days=1))


def monday_of(d: dt.date) -> dt.date:
    return d - dt.timedelta(days=d.weekday())


def week_start(c) -> Column:
    """The Monday of each row's week, as a date (NULL stays NULL)."""
    return F.date_trunc("week", as_col(c)).cast("date")


def weekday(c) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(as_col(c))


def prev_week(run: dt.date, legacy: bool = False) -> tuple[dt.date, dt.date]:
    """previous week, inclusive day bounds.

    Default: Monday..Sunday of the previous week (7 days). ``legacy=True``
    reproduces the source bounds ``d-(weekday+8)`` .. ``+7`` (Sunday to
    Sunday, 8 days; adjacent runs overlap by one day).
    """
    if legacy:
        lo = run - dt.timedelta(days=run.weekday() + 8)
        return lo, lo + dt.timedelta(days=7)
    lo = monday_of(run) - dt.timedelta(days=7)
    return lo, lo + dt.timedelta(days=6)


def current_week(run: dt.date, sunday_start: bool = False) -> tuple[dt.date, dt.date]:
    """from Monday (or the previous Sunday) of the run week to the run day."""
    lo = monday_of(run)
    if sunday_start:
        lo = lo - dt.timedelta(days=1)
    return lo, run


def fortnight(run: dt.date) -> tuple[dt.date, dt.date] | None:
    """day 16 -> 1..15 of this month; day 1 -> 16..end of previous month;
    any other day -> None (nothing to load)."""
    if run.day == 16:
        return run.replace(day=1), run.replace(day=15)
    if run.day == 1:
        last = run - dt.timedelta(days=1)
        return last.replace(day=16), last
    return None


def prev_month(run: dt.date) -> tuple[dt.date, dt.date]:
    """first..last day of the previous calendar month."""
    last = run.replace(day=1) - dt.timedelta(days=1)
    return last.replace(day=1), last


def lagged_month(run: dt.date, lag_days: int) -> tuple[dt.date, dt.date]:
    """F8: the month containing ``run - lag_days``, first..last day."""
    d = run - dt.timedelta(days=lag_days)
    return d.replace(day=1), d.replace(day=calendar.monthrange(d.year, d.month)[1])


def prev_iso_week(run: dt.date) -> tuple[dt.date, dt.date]:
    """last Sunday and the 7 days before it (Sunday..Sunday inclusive)."""
    last_sunday = run - dt.timedelta(days=(run.weekday() + 1) % 7 or 7)
    return last_sunday - dt.timedelta(days=7), last_sunday


def day_window(run: dt.date, days_back: int = 1) -> tuple[dt.date, dt.date]:
    """a single day (``days_back=0`` today, 1 yesterday)."""
    d = run - dt.timedelta(days=days_back)
    return d, d


def last_24h(now: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """``now-24h <= x < now``."""
    return now - dt.timedelta(hours=24), now


def period_path(template: str, run: dt.date) -> str:
    """Fill ``{year} {month:02d} {month_name} {yyyymm}`` from the run date."""
    return template.format(year=run.year, month=run.month,
                           month_name=SPANISH_MONTHS[run.month - 1],
                           yyyymm=f"{run.year}{run.month:02d}")
