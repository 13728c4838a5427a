"""Dates: compact strings, file names, period length."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators before the date in a name, by layout; "." ends it. "file": 20220401.json or
# log_20220401.json.gz. "folder": a day folder holding part files, as in
# 20220401.json/part-0.json or day=20220401/part-0.json.
SEPARATORS = {"file": ("_",), "folder": ("_", "=")}


def compact_date(text: Column) -> Column:
    """``yyyyMMdd`` text as a date; anything else is NULL instead of an ANSI error."""
    digits = (F.length(text) == 8) & text.try_cast("int").between(1000_01_01, 9999_12_31)
    parts = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return F.when(digits, parts.try_cast("date"))


def day_text(path: Column, layout: str = "file") -> Column:
    """The part of a log path that holds the date."""
    name = F.substring_index(path, "/", -1)
    if layout == "folder":
        name = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    for separator in SEPARATORS[layout]:
        name = F.substring_index(name, separator, -1)
    return F.substring_index(name, ".", 1)


def file_date(path: Column, layout: str = "file") -> Column:
    """Log date encoded in a file path; NULL for foreign files."""
    return compact_date(day_text(path, layout))


def listed_date(text: Column, days: Sequence[dt.date]) -> tuple[Column, Column]:
    """Whether ``text`` is one of the given days, and the day it is then.

    Evaluated for every row of a log, so by one set look-up and integer arithmetic: parsing by
    pattern and regular expressions would take several times longer than reading the row. The
    day is without meaning for other texts, but never an error.
    """
    number = text.try_cast("int")
    month = F.call_function("div", number % 10000, F.lit(100))
    first = F.make_date(
        F.call_function("div", number, F.lit(10000)).cast("int"),
        F.least(F.greatest(month, F.lit(1)), F.lit(12)).cast("int"),
        F.lit(1),
    )
    return text.isin([f"{day:%Y%m%d}" for day in days]), F.date_add(first, number % 100 - 1)


def parse_day(day: str | dt.date) -> dt.date:
    """A period bound given as a date or as ``YYYYMMDD`` text."""
    return day if isinstance(day, dt.date) else dt.datetime.strptime(day, "%Y%m%d").date()


def days_between(start: str | dt.date, end: str | dt.date) -> int:
    """Inclusive number of calendar days in the requested period."""
    days = (parse_day(end) - parse_day(start)).days + 1
    if days < 1:
        raise ValueError(f"period ends before it starts: {start}..{end}")
    return days
