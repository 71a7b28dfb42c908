"""Distinct counts and quantiles from sketches that merge like sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.operators.rollups import grouped_sets

#: Logarithm of a theta sketch's entries: one standard error of a distinct count is 1 / 64 of it.
LG_ENTRIES = 12
#: Size of a quantile sketch: the rank of an answer is within :data:`RANK_ERROR` of the one asked for, 99 times in 100.
K = 400
RANK_ERROR = 0.0083


def sketch_partials(df: DataFrame, keys: Sequence[str], distinct: Sequence[str] = (), measures: Sequence[str] = ()) -> DataFrame:
    """Sketches for one key set: ``{column}_THETA`` of distinct values and ``{column}_KLL`` of a distribution.

    NULLs are not counted. A sketch has a bounded size however many rows it stands for (about 64 KB for distinct values, some
    KB for a distribution), smaller ones are exact. They are made in the reading tasks and merged after the exchange.
    """
    made = [F.theta_sketch_agg(F.col(c), F.lit(LG_ENTRIES)).alias(f"{c}_THETA") for c in distinct]
    made += [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(K)).alias(f"{c}_KLL") for c in measures]
    return df.groupBy(*keys).agg(*made)


def _merged(distinct: Sequence[str], measures: Sequence[str]) -> list:
    unions = [F.theta_union_agg(F.col(f"{c}_THETA"), F.lit(LG_ENTRIES)).alias(f"{c}_THETA") for c in distinct]
    return unions + [F.kll_merge_agg_double(F.col(f"{c}_KLL"), F.lit(K)).alias(f"{c}_KLL") for c in measures]


def merge_sketches(partials: DataFrame, keys: Sequence[str], distinct: Sequence[str] = (), measures: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser keys from those of finer ones. A value that several of them hold counts once."""
    return partials.groupBy(*keys).agg(*_merged(distinct, measures))


def sketches_at(partials: DataFrame, grains: Mapping[str, Sequence[str]], distinct: Sequence[str] = (), measures: Sequence[str] = ()) -> DataFrame:
    """Sketches at several key sets from one pass over the partials, with the set's name in ``GRAIN``."""
    keys = list(dict.fromkeys(key for own in grains.values() for key in own))
    return grouped_sets(partials, grains, keys, _merged(distinct, measures))


def estimates(sketched: DataFrame, keys: Sequence[str], distinct: Sequence[str] = (), quantiles: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """``{column}_DISTINCT``, and ``{column}_Q{percent}`` for each quantile asked for; NULL where there is no value."""
    shown = [F.round(F.theta_sketch_estimate(F.col(f"{c}_THETA"))).cast("long").alias(f"{c}_DISTINCT") for c in distinct]
    for column, ranks in (quantiles or {}).items():
        sketch = F.col(f"{column}_KLL")
        filled = F.kll_sketch_get_n_double(sketch) > 0
        for rank in ranks:
            value = F.when(filled, F.kll_sketch_get_quantile_double(sketch, F.lit(rank)))
            shown.append(value.alias(f"{column}_Q{round(100 * rank)}"))
    return sketched.select(*keys, *shown)
