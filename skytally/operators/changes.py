"""What has changed between two publishes of a table, and results refreshed from that alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGE = "CHANGE"


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that the new table has more or less often, with by how much in ``CHANGE``.

    Equal rows are counted, not compared with each other: one aggregate with signed counts, combined in the reading
    tasks, says what ``EXCEPT ALL`` says in both directions. NULL equals NULL. Columns go by name.
    """
    signed = new.withColumn(CHANGE, F.lit(1)).unionByName(old.withColumn(CHANGE, F.lit(-1)))
    return signed.groupBy(*new.columns).agg(F.sum(CHANGE).alias(CHANGE)).filter(F.col(CHANGE) != 0)


def apply_changes(old: DataFrame, changed: DataFrame) -> DataFrame:
    """The new table from the old one and its changes, copies of a row included. A row taken away more often than it is there has no copy left."""
    signed = old.withColumn(CHANGE, F.lit(1).cast("long")).unionByName(changed.select(*old.columns, CHANGE))
    left = signed.groupBy(*old.columns).agg(F.sum(CHANGE).alias(CHANGE)).filter(F.col(CHANGE) > 0)
    return left.select(*old.columns, F.explode(F.sequence(F.lit(1), F.col(CHANGE).cast("int"))).alias("_copy")).drop("_copy")


def refresh_partials(partials: DataFrame, changed: DataFrame, keys: Sequence[str], measures: dict[str, Column], rows: str = "ROWS") -> DataFrame:
    """Sums of ``measures`` and counts of rows per key, brought up to date from changed rows alone.

    ``partials`` has the keys, ``rows`` and for each measure ``{name}_SUM`` and ``{name}_N`` (rows where it is not
    NULL). A key without rows left goes. Sums of whole numbers are exact; others may differ in the last digits from
    those made anew.
    """
    parts = [F.sum(CHANGE).alias(rows)]
    for name, value in measures.items():
        parts.append(F.sum(value * F.col(CHANGE)).alias(f"{name}_SUM"))
        parts.append(F.sum(F.when(value.isNotNull(), F.col(CHANGE)).otherwise(0)).alias(f"{name}_N"))
    added = changed.groupBy(*keys).agg(*parts)
    columns = [rows, *[f"{name}{part}" for name in measures for part in ("_SUM", "_N")]]
    both = partials.select(*keys, *columns).unionByName(added.select(*keys, *columns))
    summed = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns]).filter(F.col(rows) > 0)
    shown = [F.when(F.col(f"{name}_N") > 0, F.col(f"{name}_SUM")).alias(f"{name}_SUM") for name in measures]
    return summed.select(*keys, rows, *[c for name, s in zip(measures, shown, strict=True) for c in (s, F.col(f"{name}_N"))])


def partials_of(df: DataFrame, keys: Sequence[str], measures: dict[str, Column], rows: str = "ROWS") -> DataFrame:
    """The partials of a whole table, as :func:`refresh_partials` keeps them."""
    parts = [F.count("*").alias(rows)]
    for name, value in measures.items():
        parts += [F.sum(value).alias(f"{name}_SUM"), F.count(value).alias(f"{name}_N")]
    return df.groupBy(*keys).agg(*parts)
