"""Top-k, ordering, previews and latest-per-key views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.operators.normalise import required


def top_counts(df: DataFrame, column: str, k: int, name: str = "count", label: str | None = None) -> DataFrame:
    """The k most frequent values. Equal counts are ordered by value, so the cut is stable."""
    counts = required(df.select(column), [column]).groupBy(column).agg(F.count("*").alias(name))
    top = counts.orderBy(F.desc(name), F.asc(column)).limit(k)
    return top.withColumnRenamed(column, label) if label else top


def ordered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Ascending order for reading. Sinks do not keep it, so jobs leave it out."""
    return df.orderBy(*columns) if columns else df


def preview(df: DataFrame, rows: int) -> DataFrame:
    """Some first rows."""
    return df.limit(rows)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key. ``order`` must tell a key's rows apart.

    ``max_by`` combines before the exchange, so a key with very many rows
    sends one row per task; a window would gather them all in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_ROW")
    return df.groupBy(*keys).agg(newest).select(*keys, "_ROW.*").select(*df.columns)
