"""Messages that are sent more than once count once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skytally.functions.calendar import as_utc


def once_within(stream: DataFrame, key: str, moment: str, lateness: str) -> DataFrame:
    """The first message of each key; further ones are dropped if their moment lies within ``lateness`` of it.

    A producer that sends again what was not acknowledged in time makes such copies; position ids tell them apart, so
    the key has to come from the content. State holds a key until the watermark has passed its moment by ``lateness``,
    so it holds the keys of that span and not of all time. The watermark also drops messages that come later than
    ``lateness``: it has to cover the disorder of the source as well as the delay of a second sending.

    A message without a moment has nothing to wait for: copies are seen within a micro-batch only, none is lost. A NULL
    key is a key. Use ``append`` mode.
    """
    timed = stream
    if isinstance(stream.schema[moment].dataType, T.TimestampNTZType):
        timed = stream.withColumn("_moment", as_utc(moment))
    else:
        timed = stream.withColumn("_moment", stream[moment])
    return timed.withWatermark("_moment", lateness).dropDuplicatesWithinWatermark([key]).drop("_moment")
