"""How many intervals are open at a time, without pairing intervals and moments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def open_intervals(df: DataFrame, start: str, end: str, keys: Sequence[str] = (), name: str = "OPEN", cut_days: int = 31) -> DataFrame:
    """The moments at which the number of open intervals changes, and that number from then on.

    An interval is open from its start up to, but not at, its end; one without a start or end, or that does not end
    after its start, is never open. Every interval adds one at its start and takes one at its end; these edges are
    summed by moment in the reading tasks. Running sums go by key and cut of ``cut_days`` days: within a cut by a
    window, and each cut begins with the sum of those before it, which is one row per key and cut. No task gets
    all moments, and a key with very many intervals sends one row per task and moment.
    """
    real = df.filter(F.col(end) > F.col(start))
    pair = [F.struct(F.col(c).alias("MOMENT"), F.lit(d).alias("_d")) for c, d in ((start, 1), (end, -1))]
    edges = real.select(*keys, F.explode(F.array(*pair)).alias("_e"))
    summed = edges.groupBy(*keys, F.col("_e.MOMENT").alias("MOMENT")).agg(F.sum("_e._d").alias("_d")).filter("_d <> 0")
    summed = summed.withColumn("_cut", F.floor(F.unix_date(F.col("MOMENT").cast("date")) / cut_days))
    before = Window.partitionBy(*keys).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    totals = summed.groupBy(*keys, "_cut").agg(F.sum("_d").alias("_total"))
    carried = totals.withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0)))
    # The carried sum is one more edge at the begin of its cut, so no join is needed.
    first = carried.select(*keys, "_cut", F.col("_before").alias("_d"))
    both = summed.unionByName(first, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_cut").orderBy(F.asc_nulls_first("MOMENT")).rowsBetween(Window.unboundedPreceding, 0)
    counted = both.withColumn(name, F.sum("_d").over(inside)).filter(F.col("MOMENT").isNotNull())
    return counted.select(*keys, "MOMENT", name)


def peak(opened: DataFrame, keys: Sequence[str] = (), name: str = "OPEN") -> DataFrame:
    """The largest number open and the first moment of it, for each key."""
    best = F.min(F.struct((-F.col(name)).alias("_n"), F.col("MOMENT"))).alias("_b")
    return opened.groupBy(*keys).agg(best).select(*keys, (-F.col("_b._n")).alias(name), F.col("_b.MOMENT").alias("MOMENT"))
