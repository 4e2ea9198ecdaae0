"""Calendar column expressions (all JVM-side, no UDF).

Conventions fixed by the reference's calendar:

* ``day_of_week``: Monday = 0 … Sunday = 6 (Python ``weekday``).
* ``week_number``: ``%W`` — Monday-first weeks, days before the year's first
  Monday are week 0, so the range is 0..53.  This is *not* ISO week.
* ``is_weekend``: day_of_week >= 5; ``is_month_end``: next day is another month.
* flags are ints 0/1, never booleans.
* ``date_id``: integer ``yyyyMMdd``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(d: Column | str) -> Column:
    """Integer key yyyymmdd of a date (or date-like string / timestamp),
    computed with integer arithmetic rather than formatting text."""
    d = F.to_date(_c(d))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week(d: Column | str) -> Column:
    return F.weekday(_c(d)).cast("int")


def week_number(d: Column | str) -> Column:
    """``strftime('%W')``: (day_of_year + 6 - weekday) // 7."""
    d = _c(d)
    return F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7).cast("int")


def is_weekend(d: Column | str) -> Column:
    return (F.weekday(_c(d)) >= 5).cast("int")


def is_month_end(d: Column | str) -> Column:
    d = _c(d)
    return (F.last_day(d) == d).cast("int")


def quarter(d: Column | str) -> Column:
    return F.quarter(_c(d)).cast("int")


def month_label(d: Column | str) -> Column:
    """``yyyy-MM`` text label, kept as a string (never re-inferred)."""
    return F.date_format(_c(d), "yyyy-MM")


def iso_date(d: Column | str) -> Column:
    """``yyyy-MM-dd`` text, the reference's stored form of a date."""
    return F.date_format(_c(d), "yyyy-MM-dd")


def calendar_attributes(d: Column | str) -> dict[str, Column]:
    """The eleven ``dim_date`` attributes of a date column, in table order."""
    d = _c(d)
    return {
        "date_id": date_key(d),
        "full_date": iso_date(d),
        "year": F.year(d).cast("int"),
        "quarter": quarter(d),
        "month": F.month(d).cast("int"),
        "month_name": F.date_format(d, "MMMM"),
        "week_number": week_number(d),
        "day_of_week": day_of_week(d),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": is_weekend(d),
        "is_month_end": is_month_end(d),
    }


def days_between(start: str, end: str) -> Column:
    """Array of every date from ``start`` to ``end`` inclusive (ISO strings)."""
    return F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("interval 1 day"))
