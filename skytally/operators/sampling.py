"""Samples and splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions.keys import portable_hash, value_hash


def random_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample. Membership depends on how the input is partitioned."""
    return df.sample(fraction=fraction, seed=seed)


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Random parts. Spark sorts every partition to make them repeatable."""
    return df.randomSplit(list(weights), seed=seed)


def in_share(columns: Sequence[str], share: float, salt: str = "", portable: bool = False) -> Column:
    """Whether a row's hash lies in the first ``share`` of the hash range, which is not rounded to any grid."""
    if not 0 < share <= 1:
        raise ValueError(f"a share lies above 0 and up to 1, not {share}")
    if share == 1:
        return F.lit(True)
    if portable:
        return portable_hash(columns, salt) < F.lit(round(share * (1 << 32)))
    return value_hash(columns, salt) < F.lit(round(share * (1 << 64)) - (1 << 63))


def bucket_sample(
    df: DataFrame, columns: Sequence[str], fraction: float, salt: str = "", portable: bool = False
) -> DataFrame:
    """Rows whose values fall into the first ``fraction`` of the hash range.

    The same rows are chosen whatever the partitioning, also when a lost task
    is run again. Rows that agree on ``columns`` are chosen together, so
    ``columns`` should tell rows apart.
    """
    return df.filter(in_share(columns, fraction, salt, portable))


def bucket_split(
    df: DataFrame,
    columns: Sequence[str],
    shares: Mapping[str, float],
    salt: str = "",
    name: str = "PART",
    portable: bool = False,
) -> DataFrame:
    """Name each row's part. Shares add up to 1 and cover the hash range in the given order."""
    if abs(sum(shares.values()) - 1) > 1e-9:
        raise ValueError("shares must add up to 1")
    *head, last = shares
    upper, part = 0.0, F.lit(last)
    bounds = []
    for share in head:
        upper += shares[share]
        bounds.append((share, upper))
    for share, bound in reversed(bounds):
        part = F.when(in_share(columns, bound, salt, portable), share).otherwise(part)
    return df.withColumn(name, part)
