"""Spreadsheet dates, clock times, shifts and date parts as column functions.

A time of day is a number of seconds since midnight.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldlab.functions.numbers import as_column, to_number

SECONDS_PER_DAY = 86400

# Fixed value: stands for a missing clock time in the shore-temperature sheets.
MISSING_TIME = "12:01"

# Parse orders used by the forms.
FORMATS = {
    "mdy": "M/d/yyyy",
    "dmy": "d/M/yyyy",
    "ymd": "yyyy-M-d",
    "ymd_hms": "yyyy-M-d H:m:s",
    "hm": "H:m",
}


#: Day numbers of 0001-01-01 and 9999-12-31; cells beyond are no dates.
FIRST_SERIAL, LAST_SERIAL = -693593, 2958465


def serial_numbers(c: Column | str) -> Column:
    """An array of the spreadsheet day number (text or numeric); empty if it is no number or out of range."""
    return F.filter(F.array(to_number(c)), lambda x: (x >= FIRST_SERIAL) & (x < LAST_SERIAL + 1))


def serial_number(c: Column | str) -> Column:
    """A spreadsheet day number (text or numeric), null if it is no number or out of range.

    The text is bound by an array of one, so that it is read once, not once for each comparison.
    """
    return F.get(serial_numbers(c), F.lit(0))


def date_of_serial(x: Column | str) -> Column:
    """Date of a day number as ``serial_number`` gives it; day 0 is 1899-12-30."""
    return F.date_add(F.lit("1899-12-30").cast("date"), F.floor(as_column(x)).cast("int"))


def seconds_of_serial(x: Column | str) -> Column:
    """Fraction of a day number as ``serial_number`` gives it, as seconds of the day."""
    x = as_column(x)
    return F.round((x - F.floor(x)) * SECONDS_PER_DAY).cast("int")


def serial_date(c: Column | str) -> Column:
    """Spreadsheet day number (text or numeric) to date; day 0 is 1899-12-30. Out of range: null."""
    return date_of_serial(serial_number(c))


def serial_seconds(c: Column | str) -> Column:
    """Fraction of a spreadsheet day number as seconds of the day. Out of range: null."""
    return seconds_of_serial(serial_number(c))


def parse_date(c: Column | str, order: str) -> Column:
    """Date from text in one of the FORMATS orders; text that does not fit gives null.

    Years of two digits are 1969 to 2068.
    """
    text = F.trim(as_column(c))
    if order in ("mdy", "dmy"):
        text = F.regexp_replace(text, r"[-. ]", "/")
        text = F.regexp_replace(text, r"^([0-9]{1,2}/[0-9]{1,2})/([0-5][0-9]|6[0-8])$", "$1/20$2")
        text = F.regexp_replace(text, r"^([0-9]{1,2}/[0-9]{1,2})/([0-9]{2})$", "$1/19$2")
    elif order == "ymd":
        text = F.regexp_replace(text, r"[/. ]", "-")
        text = F.regexp_replace(text, r"^([0-5][0-9]|6[0-8])-([0-9]{1,2}-[0-9]{1,2})$", "20$1-$2")
        text = F.regexp_replace(text, r"^([0-9]{2})-([0-9]{1,2}-[0-9]{1,2})$", "19$1-$2")
    return F.to_date(F.try_to_timestamp(text, F.lit(FORMATS[order])))


def parse_moment(c: Column | str) -> Column:
    """Timestamp without zone from ``y-m-d h:m:s`` text, null if it does not fit."""
    return F.try_to_timestamp(F.trim(as_column(c)), F.lit(FORMATS["ymd_hms"])).cast("timestamp_ntz")


def clock_seconds(c: Column | str) -> Column:
    """Seconds of the day from ``h:m`` or ``h:m:s`` text, 24:00 at most; anything else gives null."""
    text = F.trim(as_column(c))
    part = F.split(text, ":")
    seconds = (
        F.get(part, F.lit(0)).try_cast("int") * 3600
        + F.get(part, F.lit(1)).try_cast("int") * 60
        + F.coalesce(F.get(part, F.lit(2)).try_cast("int"), F.lit(0))
    )
    return F.when(text.rlike(r"^(([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?|24:00(:00)?)$"), seconds)


def clock_text(c: Column | str, with_seconds: bool = True) -> Column:
    """Seconds of the day as ``HH:MM:SS`` or ``HH:MM``."""
    s = as_column(c)
    hours, minutes = F.floor(s / 3600), F.floor(s / 60) % 60
    if with_seconds:
        return F.format_string("%02d:%02d:%02d", hours, minutes, (s % 60).cast("long"))
    return F.format_string("%02d:%02d", hours, minutes)


def shift_parts(c: Column | str) -> dict[str, Column]:
    """Start, end (seconds) and length (hours) of shift text such as ``1: 8:00-14:00``.

    The length is negative when the shift crosses midnight. Text without a dash reads as both
    start and end.
    """
    span = F.regexp_replace(as_column(c), r"^[0-9]+: ", "")
    start = clock_seconds(F.regexp_replace(span, r"-.*", ""))
    end = clock_seconds(F.regexp_replace(span, r".*-", ""))
    return {
        "shift_start": start,
        "shift_end": end,
        "hours_worked": hours_between(start, end),
    }


def at_clock(day: Column | str, seconds: Column | str) -> Column:
    """Date plus seconds of the day as a timestamp without zone; null if either is missing."""
    return as_column(day).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), as_column(seconds).cast("decimal(18,6)")
    )


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Hours from one clock time (seconds) to another."""
    return (as_column(end) - as_column(start)) / 3600


def plus_minutes(c: Column | str, minutes: Column) -> Column:
    return as_column(c) + F.make_dt_interval(
        F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0).cast("decimal(18,6)")
    )


def undo_auto_date(c: Column | str) -> Column:
    """Turn a range that a spreadsheet made a date (5-10 read as 5 October) back into text."""
    day = serial_date(c)
    number = to_number(c)
    return F.when(
        number.isNotNull(), F.concat(F.month(day).cast("string"), F.lit("-"), F.day(day).cast("string"))
    ).otherwise(as_column(c))


def or_missing_time(c: Column | str) -> Column:
    return F.coalesce(as_column(c), F.lit(MISSING_TIME))
