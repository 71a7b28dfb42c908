"""Longest runs of consecutive days from summaries that can be merged.

A month of a key is a number with a bit for each day that meets the condition. From it follows a summary of a span of
days: how many days from its first on meet the condition, how many up to its last, and the longest run with its first day.
Summaries of neighbouring spans merge into that of the span they cover, so months can be added one at a time and runs
go on over the ends of months and years, without a window over days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.operators.streaks import daily_means

BITS = "DAY_BITS"
MONTH = ["YEAR", "MONTH"]
#: A summary's fields: first day (number since the epoch), days, run at its begin, run at its end, longest run and its first day.
FIELDS = ["first_day", "days", "head", "tail", "best", "best_day"]
SPAN = "SPAN"


def month_bits(days: DataFrame, keys: Sequence[str], date: str, met: Column | None = None) -> DataFrame:
    """The days of each key and month that meet a condition as bits, the first day lowest. Rows of a day may be repeated.

    A month without such a day has a row too, with no bit, so that it can replace an earlier one.
    """
    known = days.filter(F.col(date).isNotNull())
    parts = [F.year(date).alias("YEAR"), F.month(date).alias("MONTH")]
    bit = F.expr(f"shiftleft(1L, dayofmonth(`{date}`) - 1)")
    return known.groupBy(*keys, *parts).agg(F.bit_or(bit if met is None else F.when(met, bit).otherwise(0)).alias(BITS))


def delayed_months(df: DataFrame, keys: Sequence[str], date: str = "FL_DATE", measure: str = "ARR_DELAY") -> DataFrame:
    """Days whose mean is above zero, as bits by key and month."""
    return month_bits(daily_means(df, keys, date, measure), keys, date, F.col("DAY_MEAN") > 0)


def _lowest_ones(bits: Column) -> Column:
    return F.bit_count(bits.bitwiseAND(F.bitwise_not(bits + 1)))


def span_of_month() -> Column:
    """Summary of a month's bits. Its longest run is what is left when all runs are shortened day by day."""
    first = F.make_date(F.col("YEAR"), F.col("MONTH"), F.lit(1))
    days, bits = F.dayofmonth(F.last_day(first)), F.col(BITS)
    full = F.expr("shiftleft(1L, dayofmonth(last_day(make_date(YEAR, MONTH, 1)))) - 1")
    others = F.bitwise_not(bits).bitwiseAND(full)
    tail = days - F.when(others == 0, 0).otherwise(F.length(F.bin(others)))
    none = F.struct(bits.alias("ends"), bits.alias("last"), F.lit(0).alias("n"))

    def shorten(state: Column, _: Column) -> Column:
        shorter = state["ends"].bitwiseAND(F.shiftleft(state["ends"], 1))
        some = state["ends"] != 0
        return F.struct(
            F.when(some, shorter).otherwise(state["ends"]).alias("ends"),
            F.when(some, state["ends"]).otherwise(state["last"]).alias("last"),
            (state["n"] + F.when(some, 1).otherwise(0)).alias("n"),
        )

    longest = F.aggregate(F.sequence(F.lit(1), F.lit(32)), none, shorten)
    ends_at = F.bit_count(longest["last"].bitwiseAND(-longest["last"]) - 1)
    day = F.unix_date(first)
    return F.struct(
        day.alias("first_day"),
        days.alias("days"),
        _lowest_ones(bits).alias("head"),
        tail.alias("tail"),
        longest["n"].alias("best"),
        (day + ends_at - longest["n"] + 1).alias("best_day"),
    )


def merged(a: Column, b: Column) -> Column:
    """Summary of two spans, ``a`` before ``b``; days between them do not meet the condition. The earliest of equal runs counts."""
    touch = a["first_day"] + a["days"] == b["first_day"]
    over = F.when(touch, a["tail"] + b["head"]).otherwise(0)
    over_day = a["first_day"] + a["days"] - a["tail"]
    keep_a = (a["best"] >= over) & (a["best"] >= b["best"])
    take_over = over >= b["best"]
    return F.struct(
        a["first_day"].alias("first_day"),
        (b["first_day"] + b["days"] - a["first_day"]).alias("days"),
        F.when(touch & (a["head"] == a["days"]), a["days"] + b["head"]).otherwise(a["head"]).alias("head"),
        F.when(touch & (b["tail"] == b["days"]), b["days"] + a["tail"]).otherwise(b["tail"]).alias("tail"),
        F.when(keep_a, a["best"]).when(take_over, over).otherwise(b["best"]).alias("best"),
        F.when(keep_a, a["best_day"]).when(take_over, over_day).otherwise(b["best_day"]).alias("best_day"),
    )


def merge_spans(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One summary in ``SPAN`` for each key from those of spans that do not overlap, in any order.

    A key has as many spans as the calendar has months, not as many as it has flights. The result can be merged again.
    """
    ordered = F.sort_array(F.collect_list(F.col(SPAN)))
    rest = F.slice(F.col("_spans"), F.lit(2), F.size("_spans"))
    together = spans.groupBy(*keys).agg(ordered.alias("_spans"))
    return together.select(*keys, F.aggregate(rest, F.col("_spans")[0], merged).alias(SPAN))


def longest_runs(months: DataFrame, keys: Sequence[str], by_year: bool = False, name: str = "MAX_CONSEC_DELAY_DAYS") -> DataFrame:
    """Length, first and last day of the longest run of each key, from the bits of its months.

    With ``by_year``, of each key and year, and runs end with the year. Otherwise runs go on over New Year. Keys without
    a day that meets the condition have no row.
    """
    spans = months.select(*keys, "YEAR", span_of_month().alias(SPAN))
    groups = [*keys, "YEAR"] if by_year else list(keys)
    found = merge_spans(spans, groups).filter(F.col(f"{SPAN}.best") > 0)
    day = lambda c: F.date_from_unix_date(c.cast("int"))
    best, first = F.col(f"{SPAN}.best"), F.col(f"{SPAN}.best_day")
    return found.select(*groups, best.cast("int").alias(name), day(first).alias("RUN_START"), day(first + best - 1).alias("RUN_END"))
