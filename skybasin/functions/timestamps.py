"""ISO-8601 texts: hour buckets and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HOUR = r"([01]\d|2[0-3])"
_SIXTY = r"[0-5]\d"
_ZONE = rf"(Z|[+-]{_HOUR}(:?{_SIXTY}(:?{_SIXTY}([.,]\d+)?)?)?)?"
_CLOCK = rf"{_HOUR}((:{_SIXTY}(:{_SIXTY}([.,]\d+)?)?)|({_SIXTY}({_SIXTY}([.,]\d+)?)?))?"
_DASHED = rf"(?s)^\d{{4}}-\d{{2}}-\d{{2}}(.{_CLOCK}{_ZONE})?$"
_COMPACT = rf"(?s)^\d{{8}}(.{_CLOCK}{_ZONE})?$"


def valid_date(text: Column) -> Column:
    """True for a real calendar day written ``YYYY-MM-DD``; false for null.

    Such a text is what its own date prints as, which spares a regular expression.
    """
    same = (F.length(text) == 10) & (text.try_cast("date").cast("string") == text)
    return F.coalesce(same & ~text.startswith("0000"), F.lit(False))


def hour_bucket(timestamp: Column) -> Column:
    """Cut an ISO timestamp to the hour, written ``YYYY-MM-DDTHH:00:00+00:00``.

    The wall-clock hour stays and only the label becomes +00:00: parsing with
    the zone would move 14:37+07:00 to 07.  Texts that are no timestamp keep
    their first 13 characters.  The parts are cut out as text, so the session
    time zone plays no role.
    """
    dashed_day = F.substring(timestamp, 1, 10)
    dashed = timestamp.rlike(_DASHED) & _real_day(dashed_day)
    compact_day = F.concat_ws(
        "-",
        F.substring(timestamp, 1, 4),
        F.substring(timestamp, 5, 2),
        F.substring(timestamp, 7, 2),
    )
    compact = timestamp.rlike(_COMPACT) & _real_day(compact_day)
    return (
        F.when(dashed, _bucket(dashed_day, F.substring(timestamp, 12, 2)))
        .when(compact, _bucket(compact_day, F.substring(timestamp, 10, 2)))
        .otherwise(F.concat(F.substring(timestamp, 1, 13), F.lit(":00:00+00:00")))
    )


def bucket_day(bucket: Column) -> Column:
    """The day of an hour bucket, null where it has none."""
    day = F.substring(bucket, 1, 10)
    return F.when(valid_date(day), day)


def _real_day(day: Column) -> Column:
    return day.try_cast("date").isNotNull() & ~day.startswith("0000")


def _bucket(day: Column, hour: Column) -> Column:
    hour = F.when(hour == "", "00").otherwise(hour)
    return F.concat(day, F.lit("T"), hour, F.lit(":00:00+00:00"))
