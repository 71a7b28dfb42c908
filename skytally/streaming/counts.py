"""Counts over streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions.calendar import as_utc, without_zone
from skytally.functions.keys import single_id


def running_count(stream: DataFrame, key: str, name: str = "recent_flight_count", id_column: str = "id") -> DataFrame:
    """Count per key since the start, with the key as document id. Use ``update`` mode.

    State is one row per distinct key, whatever the number of messages.
    """
    counts = stream.groupBy(key).agg(F.count("*").alias(name))
    return counts.withColumn(id_column, single_id(key))


def tumbling_count(
    stream: DataFrame, moment: str, key: str, width: str = "1 minute", lateness: str = "1 hour", name: str = "count"
) -> DataFrame:
    """Count per key and event-time window.

    The watermark drops rows that come later than ``lateness`` and frees closed
    windows, so state holds open windows only. ``lateness`` has to cover the
    disorder of the source, also across micro-batches. Watermarks take
    timestamps with a zone: moments without one count as UTC, whatever the
    session's zone, and the windows come back without one.
    """
    plain = isinstance(stream.schema[moment].dataType, T.TimestampNTZType)
    if plain:
        stream = stream.withColumn(moment, as_utc(moment))
    timed = stream.withWatermark(moment, lateness)
    counts = timed.groupBy(F.window(moment, width).alias("_w"), key).agg(F.count("*").alias(name))

    def bound(field: str) -> Column:
        return without_zone(f"_w.{field}") if plain else F.col(f"_w.{field}")

    return counts.select(bound("start").alias("window_start"), bound("end").alias("window_end"), key, name)
