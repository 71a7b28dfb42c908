"""Longest run of consecutive days that meet a condition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytally.functions.calendar import day_number
from skytally.operators.normalise import required


def daily_means(df: DataFrame, keys: Sequence[str], date: str, measure: str) -> DataFrame:
    """One row per key and day with the day's mean in ``DAY_MEAN``."""
    present = required(df, [date, measure])
    return present.groupBy(*keys, date).agg(F.avg(measure).alias("DAY_MEAN"))


def longest_run(days: DataFrame, keys: Sequence[str], date: str, name: str) -> DataFrame:
    """Length of the longest run of consecutive dates per key.

    ``days`` holds at most one row per key and date. Inside a run the day number
    and the row number rise together, so their difference marks the run. A
    window partition holds one key's dates and is bounded by the calendar
    (366 rows when a year is among the keys), not by the size of the input.
    The run lengths are counted on partitions the window has made, with no
    further exchange.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(date))
    marked = days.select(*keys, (day_number(F.col(date)) - position).alias("_RUN"))
    lengths = marked.groupBy(*keys, "_RUN").agg(F.count("*").alias("_LENGTH"))
    return lengths.groupBy(*keys).agg(F.max("_LENGTH").cast("int").alias(name))


def longest_delay_run(
    df: DataFrame,
    keys: Sequence[str],
    date: str = "FL_DATE",
    measure: str = "ARR_DELAY",
    name: str = "MAX_CONSEC_DELAY_DAYS",
) -> DataFrame:
    """Longest run of days whose mean is above zero. Keys without such a day are absent."""
    delayed = daily_means(df, keys, date, measure).filter(F.col("DAY_MEAN") > 0)
    return longest_run(delayed, keys, date, name)
