"""Event-date parsing: four text layouts -> start and end dates.

Layouts (fixed values, anchored; NULL or anything else is ``unknown_format``):

- ``single_date``                 ``05.04.2003``
- ``date_range_same_month``       ``11.-12.06.2005``
- ``date_range_different_month``  ``29.05.-02.06.2007`` (start year = end year,
                                  minus one when the start month is later)
- ``date_range_different_year``   ``30.12.2009-02.01.2010``

The dates are made of the numbers in the text, with a check of the calendar,
so impossible dates such as ``00.08.2004`` or ``30.02.2011`` become NULL rather
than failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from racelake.functions.columns import as_col

# Layout name -> anchored pattern whose groups are the date parts.
DATE_LAYOUTS = {
    "single_date": r"^(\d{2})\.(\d{2})\.(\d{4})$",
    "date_range_same_month": r"^(\d{2})\.-(\d{2})\.(\d{2})\.(\d{4})$",
    "date_range_different_month": r"^(\d{2})\.(\d{2})\.-(\d{2})\.(\d{2})\.(\d{4})$",
    "date_range_different_year": r"^(\d{2})\.(\d{2})\.(\d{4})-(\d{2})\.(\d{2})\.(\d{4})$",
}
UNKNOWN_LAYOUT = "unknown_format"


def classify_date_format(c: Column | str) -> Column:
    c = as_col(c)
    expr = None
    for name, pattern in DATE_LAYOUTS.items():
        expr = (F.when(c.rlike(pattern), name) if expr is None
                else expr.when(c.rlike(pattern), name))
    return expr.otherwise(UNKNOWN_LAYOUT)


def _number(c: Column, pos: int, length: int = 2) -> Column:
    return F.substring(c, pos, length).try_cast("int")


def _date(day: Column, month: Column, year: Column) -> Column:
    """The date; NULL for parts that name none (day 0, 30 February, month 13)."""
    named = month.between(1, 12) & day.between(1, 31) & year.between(0, 9999)
    found = F.date_add(F.make_date(year, month, F.lit(1)), day - 1)
    return F.when(named, F.when(F.month(found) == month, found))


def event_date_bounds(c: Column | str, layout: Column | str | None = None) -> tuple[Column, Column]:
    """(start, end) dates of an event-date text.

    Every layout has fixed width, so once the layout is known the day, month and year
    are plain substrings and the date is made of their numbers: a failed text parse would
    cost a caught exception inside the JVM.  ``layout`` is the stored column of
    ``classify_date_format``; without it the layout is matched here, which keeps the
    expression small where Catalyst inlines it into a pushed-down filter.

    Offsets (1-based): ``DD.-DD.MM.YYYY``: days 1 and 5, month 8, year 11;
    ``DD.MM.-DD.MM.YYYY``: start 1 and 4, end 8 and 11, year 14;
    ``DD.MM.YYYY-DD.MM.YYYY``: start 1, end 12.
    """
    c = as_col(c)
    single = F.when(F.length(c) == 10, _date(_number(c, 1), _number(c, 4), _number(c, 7, 4)))
    same = [_date(_number(c, day), _number(c, 8), _number(c, 11, 4)) for day in (1, 5)]
    # Start year rolls back one year when the start month is later (Dec -> Jan); it needs four digits.
    start_year = _number(c, 14, 4) - F.when(_number(c, 4) > _number(c, 11), 1).otherwise(0)
    month_start = F.when(start_year >= 1000, _date(_number(c, 1), _number(c, 4), start_year))
    month_end = _date(_number(c, 8), _number(c, 11), _number(c, 14, 4))
    year_start, year_end = [_date(_number(c, at), _number(c, at + 3), _number(c, at + 6, 4)) for at in (1, 12)]

    def by_layout(*dates):
        expr = F
        for (name, pattern), value in zip(DATE_LAYOUTS.items(), dates):
            expr = expr.when(c.rlike(pattern) if layout is None else as_col(layout) == name, value)
        return expr

    return (by_layout(single, same[0], month_start, year_start),
            by_layout(single, same[1], month_end, year_end))


def event_duration_days(start: Column | str, end: Column | str) -> Column:
    """Days between start and end date (0 for a one-day event)."""
    return F.date_diff(as_col(end), as_col(start))


def dates_in_order(start: Column | str, end: Column | str) -> Column:
    """The planned order check: the end is not before the start."""
    return as_col(end) >= as_col(start)


def date_key(c: Column | str) -> Column:
    """``yyyyMMdd`` integer surrogate key of a date."""
    return F.date_format(as_col(c), "yyyyMMdd").cast("int")


def month_name(month: Column) -> Column:
    """English name of a month number."""
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMMM")
