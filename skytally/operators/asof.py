"""As-of join: each row of one table with the last earlier row of another that has the same keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions.calendar import as_utc

#: Rows of a key that are to meet in one task at most, if its rows are spread evenly over time.
ROWS_PER_CUT = 2_000_000


def _number(column: str, kind: T.DataType) -> Column:
    """A moment as a number that rises with it: microseconds for dates and timestamps."""
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long") * 86_400_000_000
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(as_utc(column))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    return F.col(column).cast("double")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    strict: bool = False,
    rows_per_cut: int = ROWS_PER_CUT,
) -> DataFrame:
    """``left`` with ``columns`` of the last row of ``right`` of the same keys at or before its moment (before, if ``strict``).

    Rows without such a row, and those whose key or moment is NULL, have NULL there; every row of ``left`` comes out
    once. Of several right rows of a key and moment the one with the largest values in ``columns`` counts, so these need
    an order. Names of ``columns`` must not be names of ``left``; both moments have the same type.

    Both tables are put in one order by key and moment and the last right row is carried forward, so no pairs are made.
    The tables are cut in time, all keys alike, so finely that the key with most rows leaves ``rows_per_cut`` in a cut;
    the window then works on key and cut. What a cut begins with, the last right row of all cuts before it, is one
    row per key and cut, put at the cut's begin. Without a heavy key there is one cut and nothing to carry. Rows of one
    key and moment cannot be cut apart.
    """
    clash = set(columns) & set(left.columns)
    if clash:
        raise ValueError(f"columns of both tables: {sorted(clash)}")
    kind = left.schema[left_time].dataType
    if kind != right.schema[right_time].dataType:
        raise ValueError(f"{left_time} and {right_time} differ in type")
    keys = [f"_k{i}" for i in range(len(on))]

    def prepared(df: DataFrame, time: str, side: int, payload: str, names: Sequence[str]) -> DataFrame:
        whole = F.struct(*[F.col(c) for c in names]).alias(payload)
        named = [F.col(c).alias(k) for c, k in zip(on, keys, strict=True)]
        return df.select(*named, F.col(time).alias("_t"), F.lit(side).alias("_side"), whole, _number(time, kind).alias("_n"))

    whole_left = prepared(left, left_time, 1, "_l", left.columns)
    whole_right = prepared(right, right_time, 2 if strict else 0, "_r", columns)
    known = F.col("_t").isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    ours, theirs = whole_left.filter(known), whole_right.filter(known)
    width, start, cuts = _cuts(ours, theirs, keys, rows_per_cut)
    number = F.least(F.floor((F.col("_n").cast("double") - F.lit(start)) / F.lit(width)).cast("long"), F.lit(cuts - 1)) if cuts > 1 else F.lit(0).cast("long")
    ours, theirs = [df.withColumn("_cut", number).drop("_n") for df in (ours, theirs)]
    rows = ours.unionByName(theirs, allowMissingColumns=True)
    if cuts > 1:
        rows = rows.unionByName(_carried(ours, theirs, keys), allowMissingColumns=True)
    forward = Window.partitionBy(*keys, "_cut").orderBy(F.asc_nulls_first("_t"), "_side", "_r")
    found = rows.withColumn("_last", F.last("_r", ignorenulls=True).over(forward)).filter("_l IS NOT NULL")
    alone = whole_left.filter(~known).select("_l").withColumn("_last", F.lit(None).cast(rows.schema["_r"].dataType))
    return found.select("_l", "_last").unionByName(alone).select("_l.*", *[F.col(f"_last.{c}").alias(c) for c in columns])


def _cuts(ours: DataFrame, theirs: DataFrame, keys: Sequence[str], rows_per_cut: int) -> tuple[float, float, int]:
    """Width, begin and number of the cuts, from the heaviest key: one light pass over keys and moments."""
    both = ours.select(*keys, "_n").unionByName(theirs.select(*keys, "_n"))
    sizes = both.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_n").alias("low"), F.max("_n").alias("high"))
    most, low, high = sizes.agg(F.max("n"), F.min("low"), F.max("high")).first()
    cuts = -(-(most or 0) // rows_per_cut)
    if cuts <= 1 or high <= low:
        return 1.0, 0.0, 1
    return (float(high) - float(low)) / cuts, float(low), int(cuts)


def _carried(ours: DataFrame, theirs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each key and cut with rows of the left table: the last right row of the cuts before, if there is one."""
    last = theirs.groupBy(*keys, "_cut").agg(F.max_by("_r", F.struct("_t", "_r")).alias("_r"))
    wanted = ours.select(*keys, "_cut").distinct()
    places = last.withColumn("_wanted", F.lit(False)).unionByName(wanted.withColumn("_wanted", F.lit(True)), allowMissingColumns=True)
    merged = places.groupBy(*keys, "_cut").agg(F.max("_r").alias("_r"), F.max("_wanted").alias("_wanted"))
    before = Window.partitionBy(*keys).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    carried = merged.withColumn("_c", F.last("_r", ignorenulls=True).over(before)).filter("_wanted AND _c IS NOT NULL")
    return carried.select(*keys, "_cut", F.lit(-1).alias("_side"), F.col("_c").alias("_r"))
