"""Calendar parts and event times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_parts(date: Column) -> dict[str, Column]:
    """YEAR, MONTH, DAYOFMONTH and DAYOFWEEK, the last with Sunday = 1."""
    return {
        "YEAR": F.year(date),
        "MONTH": F.month(date),
        "DAYOFMONTH": F.dayofmonth(date),
        "DAYOFWEEK": F.dayofweek(date),
    }


EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def as_utc(moment: str) -> Column:
    """A moment without zone as the same clock time in UTC, whatever the session's zone."""
    since = f"(`{moment}` - {EPOCH})"  # an interval; differences by unit would go through the session's zone
    minutes = f"((extract(DAY FROM {since}) * 24L + extract(HOUR FROM {since})) * 60 + extract(MINUTE FROM {since}))"
    return F.timestamp_micros(F.expr(f"{minutes} * 60000000 + bigint(extract(SECOND FROM {since}) * 1000000)"))


def without_zone(moment: str) -> Column:
    """The clock time in UTC of a moment, without zone."""
    return F.expr(f"{EPOCH} + make_dt_interval(0, 0, 0, unix_micros({moment}) / 1000000)")


def day_number(date: Column) -> Column:
    """Days since the Unix epoch: consecutive dates have consecutive numbers."""
    return F.unix_date(date)


def clock_timestamp(date: Column, hhmm: Column) -> Column:
    """Moment without zone of an ISO date text and an HHMM text of one to four digits; ``2400`` is the next midnight.

    Anything else gives NULL.
    """
    readable = F.trim(hhmm).rlike("^[0-9]{1,4}$") & F.trim(date).rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    digits = F.lpad(F.trim(hhmm), 4, "0")
    next_midnight = digits == "2400"
    clock = F.when(next_midnight, "00:00").otherwise(F.concat_ws(":", F.substring(digits, 1, 2), F.substring(digits, 3, 2)))
    moment = F.concat_ws(" ", F.trim(date), clock).try_cast("timestamp_ntz")
    return F.when(readable, F.when(next_midnight, moment + F.expr("INTERVAL 1 DAY")).otherwise(moment))
