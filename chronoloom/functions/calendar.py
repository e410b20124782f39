"""Calendar arithmetic as Column expressions.

Each time unit maps an index value to a dense integer period number and back,
so that every model can work on whole-number time.  All expressions stay on
``DATE`` / ``TIMESTAMP_NTZ`` values and do not depend on the session time zone.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F

# Sub-daily units in minutes.
MINUTE_UNITS = {"minute": 1, "5min": 5, "15min": 15, "30min": 30, "hour": 60}

# Default seasonal period and periods per year for each unit.
DEFAULT_PERIOD = {
    "year": 1, "quarter": 4, "month": 12, "week": 52, "day": 7,
    "hour": 24, "30min": 48, "15min": 96, "5min": 288, "minute": 1440, "int": 1,
}
PER_YEAR = {
    "year": 1, "quarter": 4, "month": 12, "week": 365.25 / 7, "day": 365.25,
    "hour": 8766, "30min": 17532, "15min": 35064, "5min": 105192, "minute": 525960,
}
NAMED_PERIODS = {"year", "quarter", "month", "week", "day", "hour"}


def period_number(col: Column, unit: str) -> Column:
    """Dense integer number of the period that holds ``col``."""
    if unit == "int":
        return col.cast("long")
    if unit == "year":
        return F.year(col).cast("long")
    if unit == "quarter":
        return (F.year(col) * 4 + F.quarter(col) - 1).cast("long")
    if unit == "month":
        return (F.year(col) * 12 + F.month(col) - 1).cast("long")
    days = F.unix_date(F.to_date(col)).cast("long")
    if unit == "week":  # ISO weeks start on Monday; day 0 is a Thursday
        return F.floor((days + 3) / 7)
    if unit == "day":
        return days
    width = MINUTE_UNITS[unit]
    return F.floor((days * 1440 + F.hour(col) * 60 + F.minute(col)) / width)


def period_start(t: Column, unit: str) -> Column:
    """Inverse of :func:`period_number`: first instant of period ``t``."""
    if unit == "int":
        return t.cast("long")
    if unit == "year":
        return F.make_date(t.cast("int"), F.lit(1), F.lit(1))
    if unit == "quarter":
        return F.make_date(F.floor(t / 4).cast("int"), (F.pmod(t, F.lit(4)) * 3 + 1).cast("int"), F.lit(1))
    if unit == "month":
        return F.make_date(F.floor(t / 12).cast("int"), (F.pmod(t, F.lit(12)) + 1).cast("int"), F.lit(1))
    if unit == "week":
        return F.date_from_unix_date((t * 7 - 3).cast("int"))
    if unit == "day":
        return F.date_from_unix_date(t.cast("int"))
    width = MINUTE_UNITS[unit]
    day = F.date_from_unix_date(F.floor(t * width / 1440).cast("int")).cast("timestamp_ntz")
    minutes = F.pmod(t * width, F.lit(1440)).cast("int")
    return day + F.make_dt_interval(F.lit(0), F.lit(0), minutes)


def truncate(col: Column, unit: str) -> Column:
    """Index value of the period that holds ``col``."""
    return period_start(period_number(col, unit), unit)


def periods_in(name: str | float, unit: str) -> float:
    """Length of a named season ("day", "week", "year") in units."""
    if not isinstance(name, str):
        return float(name)
    year = PER_YEAR[unit]
    return {"year": year, "quarter": year / 4, "month": year / 12,
            "week": year / (365.25 / 7), "day": year / 365.25, "hour": year / 8766}[name]


def horizon(h: int | str | None, unit: str, period: float | None = None) -> int:
    """``12``, ``"3 years"``, ``"2 weeks"``; default two seasons, ten if none."""
    if h is None:
        m = period if period is not None else DEFAULT_PERIOD[unit]
        return int(2 * round(m)) if m > 1 else 10
    if isinstance(h, int):
        return h
    n, name = h.split()
    return int(round(float(n) * periods_in(name.rstrip("s"), unit)))


def _next(start: date, unit: str, n: int = 1) -> date:
    if unit in ("year", "quarter", "month"):
        months = start.year * 12 + start.month - 1 + n * {"year": 12, "quarter": 3, "month": 1}[unit]
        return date(months // 12, months % 12 + 1, 1)
    return start + timedelta(days=n * {"week": 7, "day": 1}[unit])


# The accepted partial-date spellings.
_PARTIAL = [
    (re.compile(r"^(\d{4})$"), "year"),
    (re.compile(r"^(\d{4}) Q([1-4])$"), "quarter"),
    (re.compile(r"^(\d{4}) W(\d{1,2})$"), "week"),
    (re.compile(r"^(\d{4}) ([A-Z][a-z]{2})$"), "month_name"),
    (re.compile(r"^(\d{4})-(\d{2})$"), "month"),
    (re.compile(r"^(\d{4})-(\d{2})-(\d{2})$"), "day"),
]


def partial_date(text: str) -> tuple[date, date]:
    """Expand ``"1970 Q1"``, ``"2016 Jan"``, ``"1991 W52"``, ``"2007"`` ... to
    the half-open date range [first day, first day after]."""
    for pattern, kind in _PARTIAL:
        hit = pattern.match(text.strip())
        if not hit:
            continue
        year = int(hit[1])
        if kind == "year":
            start, unit = date(year, 1, 1), "year"
        elif kind == "quarter":
            start, unit = date(year, 3 * int(hit[2]) - 2, 1), "quarter"
        elif kind == "week":
            start, unit = date.fromisocalendar(year, int(hit[2]), 1), "week"
        elif kind == "month_name":
            start, unit = datetime.strptime(text.strip(), "%Y %b").date(), "month"
        elif kind == "month":
            start, unit = date(year, int(hit[2]), 1), "month"
        else:
            start, unit = date(year, int(hit[2]), int(hit[3])), "day"
        return start, _next(start, unit)
    raise ValueError(f"not a partial date: {text!r}")


def wday(col: Column, week_start: int = 7) -> Column:
    """Day of week 1..7; ``week_start`` 7 counts from Sunday, 1 from Monday."""
    monday0 = F.weekday(col)
    return (F.pmod(monday0 - (week_start - 1), F.lit(7)) + 1).cast("int")


def yearquarter_label(col: Column) -> Column:
    return F.concat(F.year(col).cast("string"), F.lit(" Q"), F.quarter(col).cast("string"))


def yearmonth_label(col: Column) -> Column:
    return F.date_format(col, "yyyy MMM")


def yearweek_label(col: Column) -> Column:
    """ISO year and week; the ISO year is the year of that week's Thursday."""
    thursday = F.date_add(F.date_trunc("week", col).cast("date"), 3)
    return F.concat(F.year(thursday).cast("string"), F.lit(" W"),
                    F.lpad(F.weekofyear(col).cast("string"), 2, "0"))
