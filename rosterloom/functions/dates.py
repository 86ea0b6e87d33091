"""Dates, monthly periods and month keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date spellings, with an optional time of day where one may follow.
_TIME = r"(?:[01]?[0-9]|2[0-3]):[0-5]?[0-9]"
DATE_SPELLINGS = (
    rf"([0-9]{{4}})-([0-9]{{1,2}})-([0-9]{{1,2}})(?: {_TIME}:[0-5]?[0-9])?",  # yyyy-MM-dd [HH:mm:ss]
    rf"([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}})(?: {_TIME}(?::[0-5]?[0-9])?)?",  # dd/MM/yyyy [time]
    r"([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})",  # dd-MM-yyyy
    r"([0-9]{4})([0-9]{2})([0-9]{2})",  # yyyyMMdd
)
# One pattern for all of them, and for anything else. Groups that take no part are empty, so each
# spelling becomes year-month-day and everything else becomes '--', which is no date.
_ANY_SPELLING = rf"(?Us)^\s*(?:{'|'.join(DATE_SPELLINGS)}|.*)\s*$"
_YEAR_MONTH_DAY = "$1$6$9$10-$2$5$8$11-$3$4$7$12"
# Spreadsheet serial numbers count days from this date; four to six digits, not zero.
SERIAL_SHAPE = r"(?U)^\s*(?!0+(?:\.|\s*$))([0-9]{4,6})(?:\.0+)?\s*$"
SERIAL_EPOCH = dt.date(1899, 12, 30)
# Fixed value: month and year inside a file name, as in ``Quadro 05-2026.xlsx``.
MONTH_IN_NAME = r"(?:^|\D)(\d{2}-\d{4})(?:\D|$)"


def parse_date(c: Column) -> Column:
    """Text in any accepted spelling, or a spreadsheet serial number, as a date.

    Rewriting to one spelling and casting needs no formatter per pattern, raises nothing on rows
    that do not fit, and keeps the generated code small enough to be compiled.
    """
    text = c.cast("string")
    serial = F.regexp_extract(text, SERIAL_SHAPE, 1).try_cast("int")
    return F.coalesce(
        F.regexp_replace(text, _ANY_SPELLING, _YEAR_MONTH_DAY).try_cast("date"),
        F.date_add(F.lit(SERIAL_EPOCH), serial),
    )


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def month_end(d: Column) -> Column:
    return F.last_day(d)


def add_months_to(d: Column, months: int) -> Column:
    return F.add_months(d, months)


def month_key(period: Column, person: Column) -> Column:
    """``dd/MM/yyyy_person``; null when either side is null.

    The years 1 to 9999 are turned around as text, which costs less than formatting a time.
    """
    iso = period.cast("date").cast("string")
    usual = (F.length(iso) == 10) & ~F.startswith(iso, F.lit("0000"))
    parts = [F.substring(iso, 9, 2), F.substring(iso, 6, 2), F.substring(iso, 1, 4)]
    day = F.when(usual, F.concat_ws("/", *parts)).otherwise(F.date_format(period, "dd/MM/yyyy"))
    return F.concat(day, F.lit("_"), person)


def previous_month_key(period: Column, person: Column) -> Column:
    """The month key of the month before ``period``."""
    return month_key(add_months_to(period, -1), person)


def period_from_file_name(name: Column) -> Column:
    """First day of the ``MM-yyyy`` found in a file name; null for years and ranges."""
    found = F.regexp_extract(name, MONTH_IN_NAME, 1)
    return F.regexp_replace(found, "^(..)-(....)$", "$2-$1-01").try_cast("date")


def complete_months(start: Column, end: Column) -> Column:
    """Whole months between two dates. Unlike ``months_between`` there is no end-of-month rule."""
    months = (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))
    unfinished = F.when(F.day(end) < F.day(start), 1).otherwise(0)
    return (months - unfinished).cast("bigint")


def first_known_period(
    stated: Column | None, file_name: Column | None, default: dt.date | None
) -> Column:
    """Stated period, else the one in the file name, else the default. Never corrected."""
    options = []
    if stated is not None:
        options.append(stated)
    if file_name is not None:
        options.append(period_from_file_name(file_name))
    options.append(F.lit(default).cast("date"))
    return F.coalesce(*options)
