"""Text to typed columns. Bad text gives NULL, also under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(text, pattern)


def as_float(text: Column) -> Column:
    return text.try_cast("float")


def as_floats(columns: Sequence[str]) -> Column:
    """:func:`as_float` of several columns, as an array.

    ``transform`` also keeps the projection it stands in out of whole-stage code, where a wide projection makes one method
    that HotSpot does not compile; outside, Spark splits it.
    """
    return F.transform(F.array(*columns), as_float)


def as_double(text: Column) -> Column:
    return text.try_cast("double")


def as_flag(text: Column) -> Column:
    """Flags are written as ``0.00`` and ``1.00``, hence the step over double."""
    return text.try_cast("double").try_cast("int")


CONVERSIONS = {"date": as_date, "float": as_float, "flag": as_flag, "text": lambda text: text}
