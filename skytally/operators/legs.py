"""Repeated groups of columns (first leg, second leg, ...) as rows, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEG = "LEG"


def to_legs(df: DataFrame, keys: Sequence[str], fields: Sequence[str], count: int, prefix: str = "Div") -> DataFrame:
    """One row for each group ``{prefix}{n}{field}`` (n from 1) that holds any value, with its number in ``LEG``.

    The groups become an array of structs that is exploded in place: no exchange, one pass. A group of NULLs is no leg, also
    between others, so numbers may have holes. A row without legs has none.
    """
    groups = [F.struct(F.lit(n).alias(LEG), *[F.col(f"{prefix}{n}{f}").alias(f) for f in fields]) for n in range(1, count + 1)]
    filled = F.filter(F.array(*groups), lambda leg: F.coalesce(*[leg[f].cast("string") for f in fields]).isNotNull())
    exploded = df.select(*keys, F.explode(filled).alias("_leg"))
    return exploded.select(*keys, f"_leg.{LEG}", *[f"_leg.{f}" for f in fields])


def from_legs(legs: DataFrame, keys: Sequence[str], fields: Sequence[str], count: int, prefix: str = "Div") -> DataFrame:
    """One row per key with its legs in groups of columns; absent legs are NULL, those numbered above ``count`` an error.

    Legs are gathered by one aggregate without a list of pivot values, combined in the reading tasks. Of two legs with the
    same key and number the one with the largest values counts.
    """
    bad = F.raise_error(F.concat(F.lit("no column for leg "), F.col(LEG).cast("string")))
    checked = legs.withColumn(LEG, F.when(F.col(LEG).between(1, count), F.col(LEG)).otherwise(bad.cast("int")))
    whole = F.struct(*[F.col(f) for f in fields])
    gathered = checked.groupBy(*keys).agg(*[F.max(F.when(F.col(LEG) == n, whole)).alias(f"_{n}") for n in range(1, count + 1)])
    return gathered.select(*keys, *[F.col(f"_{n}.{f}").alias(f"{prefix}{n}{f}") for n in range(1, count + 1) for f in fields])
