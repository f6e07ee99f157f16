"""Epochs, date keys and calendar attributes, free of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A larger epoch counts milliseconds; the rest bound years 1 to 9999.
LARGEST_SECONDS = 9_999_999_999
LARGEST_MILLIS = 253_402_300_799_999
SMALLEST_SECONDS = -62_135_596_800


def _micros(epoch: Column) -> Column:
    """Epoch seconds or milliseconds as microseconds; NULL outside years 1-9999."""
    return F.when(
        epoch.between(SMALLEST_SECONDS, LARGEST_SECONDS), epoch * 1_000_000
    ).when((epoch > LARGEST_SECONDS) & (epoch <= LARGEST_MILLIS), epoch * 1_000)


# A written date and time, and one that names its zone.
WRITTEN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?"
ZONE = r"(Z|[+-]\d{2}:?\d{2})$"


def epoch_of(text: Column) -> Column:
    """An epoch from its digits, or the whole seconds of an ISO 8601 time; one without a zone
    is a UTC clock reading. NULL for anything else."""
    start = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    clock = F.floor(F.timestamp_diff("MICROSECOND", start, text.try_cast("timestamp_ntz")) / 1_000_000)
    instant = F.unix_seconds(text.try_cast("timestamp"))
    written = F.when(text.rlike(WRITTEN + ZONE), instant).when(text.rlike(WRITTEN + "$"), clock)
    return F.coalesce(text.try_cast("bigint"), written)


def event_time(epoch: Column) -> Column:
    """An epoch as a UTC clock reading."""
    start = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.timestamp_add("MICROSECOND", _micros(epoch), start)


def event_instant(epoch: Column) -> Column:
    """A dated epoch as an instant, the type watermarks need."""
    return F.when(epoch != 0, F.timestamp_micros(_micros(epoch)))


def date_key_of(day: Column) -> Column:
    """A date or time as the integer yyyyMMdd."""
    return F.year(day) * 10_000 + F.month(day) * 100 + F.day(day)


def view_date(epoch: Column) -> Column:
    """Calendar date of an epoch; a zero or missing epoch has none."""
    return F.when(epoch != 0, F.to_date(event_time(epoch)))


def dated_time(epoch: Column) -> Column:
    """The clock reading of an epoch that has a date, NULL for the others."""
    return F.when(epoch != 0, event_time(epoch))


def date_key(epoch: Column) -> Column:
    return date_key_of(view_date(epoch))


def calendar(day: Column) -> dict[str, Column]:
    """The attributes of the date dimension, by column name."""
    return {
        "date_id": date_key_of(day),
        "full_date": day,
        "date_of_week": F.date_format(day, "EEEE"),
        "date_of_week_short": F.date_format(day, "E"),
        "is_weekday_or_weekend": F.when(F.weekday(day) >= 5, "weekend").otherwise("weekday"),
        "day_of_month": F.day(day),
        "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day),
        "quarter_number": F.quarter(day),
        "year_number": F.year(day),
        "year_month": F.date_format(day, "yyyyMM"),
    }


def local_clock(text: Column) -> Column:
    """Text ``yyyy-MM-dd HH:mm:ss`` as a time; anything else is NULL."""
    shaped = text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
    return F.when(shaped, text.try_cast("timestamp_ntz"))
