"""Date and time columns. ``as_of`` replaces the wall clock everywhere."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_LOCAL_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z?$"


def as_date(as_of: date | datetime | str | Column) -> Column:
    """Return `as_of` as a date column."""
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date")


def as_timestamp(as_of: datetime | str | Column) -> Column:
    """Return `as_of` as a timestamp column; text is read as UTC."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    if isinstance(as_of, datetime):
        as_of = as_of.isoformat()
    zoned = as_of.endswith("Z") or "+" in as_of[10:]
    return F.lit(as_of if zoned else as_of + "Z").cast("timestamp")


def strict_date(text: Column) -> Column:
    """Read ``YYYY-MM-DD``; anything looser is null."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(ISO_DATE), trimmed).try_cast("date")


def age_years(dob: Column, as_of: date | str | Column) -> Column:
    """Whole years between a date-of-birth text and `as_of`; null if it is no date."""
    born, today = strict_date(dob), as_date(as_of)
    birthday_ahead = F.date_format(today, "MMdd") < F.date_format(born, "MMdd")
    return F.year(today) - F.year(born) - F.when(birthday_ahead, 1).otherwise(0)


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text, optional ``Z``, to a UTC timestamp cut to milliseconds."""
    utc = F.when(text.rlike(ISO_LOCAL_TIMESTAMP), F.concat(F.rtrim(text, F.lit("Z")), F.lit("Z")))
    return F.date_trunc("millisecond", utc.try_cast("timestamp"))


def iso_date_part(text: Column) -> Column:
    """The part of an ISO text before its ``T``."""
    return F.split_part(text, F.lit("T"), F.lit(1))


def is_recent(text: Column, as_of: date | str | Column) -> Column:
    """True where the time is missing or not before the day preceding `as_of`."""
    return text.isNull() | (
        iso_date_part(text).try_cast("date") >= F.date_sub(as_date(as_of), 1)
    )
