"""Grouped tables: means, totals, event rates and counts.

The ``*_by`` functions aggregate rows directly. ``partial_rollup`` keeps sums and
counts that can be added up further, for several key sets in one pass, and the
``merge_*`` functions turn them into the same tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.functions.keys import joined_id
from skytally.operators.normalise import required

ROWS = "N_ROWS"


def mean_by(df: DataFrame, keys: Sequence[str], means: Mapping[str, str]) -> DataFrame:
    """Mean of each measure per key; ``means`` maps result name to column."""
    return df.groupBy(*keys).agg(*[F.avg(column).alias(name) for name, column in means.items()])


def total_by(df: DataFrame, keys: Sequence[str], totals: Mapping[str, str]) -> DataFrame:
    """Sum of each measure per key, over rows in which all measures have a value."""
    present = required(df, list(totals.values()))
    return present.groupBy(*keys).agg(*[F.sum(column).alias(name) for name, column in totals.items()])


def rate_by(
    df: DataFrame, keys: Sequence[str], events: Mapping[str, Column], total: str = "TOTAL_FLIGHTS"
) -> DataFrame:
    """Count and percentage of rows that meet each condition, per key."""
    counted = df.groupBy(*keys).agg(
        *[F.count_if(condition).alias(f"{name}_COUNT") for name, condition in events.items()],
        F.count("*").alias(total),
    )
    return _with_percentages(counted, keys, list(events), total)


def count_by(df: DataFrame, keys: Sequence[str], name: str, counted: str | None = None) -> DataFrame:
    """Rows per key, or rows in which ``counted`` has a value."""
    return df.groupBy(*keys).agg(F.count(counted or "*").alias(name))


def summary_by(
    df: DataFrame, keys: Sequence[str], means: Mapping[str, str], rows: str, id_column: str | None = None
) -> DataFrame:
    """Means and row count per key, for rows whose first key has a value, with a joined id.

    The condition on the key is applied before grouping.
    """
    summary = (
        df.filter(F.col(keys[0]).isNotNull())
        .groupBy(*keys)
        .agg(*[F.avg(column).alias(name) for name, column in means.items()], F.count("*").alias(rows))
    )
    return summary.withColumn(id_column, joined_id(keys)) if id_column else summary


def _with_percentages(counted: DataFrame, keys: Sequence[str], events: Sequence[str], total: str) -> DataFrame:
    shaped = []
    for name in events:
        shaped += [
            (F.try_divide(F.col(f"{name}_COUNT"), F.col(total)) * 100.0).alias(f"{name}_PERC"),
            F.col(f"{name}_COUNT"),
        ]
    return counted.select(*keys, *shaped, total)


def partials_by(
    df: DataFrame,
    keys: Sequence[str],
    means: Sequence[str] = (),
    totals: Sequence[str] = (),
    events: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Mergeable sums and counts for one key set."""
    return df.groupBy(*keys).agg(*_parts(means, totals, events))


def partial_rollup(
    df: DataFrame,
    grains: Mapping[str, Sequence[str]],
    means: Sequence[str] = (),
    totals: Sequence[str] = (),
    events: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Mergeable sums and counts for several key sets, in one scan and one exchange.

    The result has a ``GRAIN`` column with the key set's name. ``GRAIN`` comes
    from ``grouping_id``: a key that is NULL in the data and a key that the
    grain leaves out look the same otherwise.
    """
    return grouped_sets(df, grains, _all_keys(grains), _parts(means, totals, events))


def merge_partials(partials: DataFrame, grains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Partial sums of coarser key sets, added up from finer ones."""
    return grouped_sets(partials, grains, _all_keys(grains), _added_up(partials))


def merge_means(partials: DataFrame, keys: Sequence[str], means: Mapping[str, str]) -> DataFrame:
    """Same table as :func:`mean_by`, from partial sums."""
    merged = _merge(partials, keys, [f"{c}{part}" for c in means.values() for part in ("_SUM", "_N")])
    return merged.select(*keys, *[mean_of(column).alias(name) for name, column in means.items()])


def merge_totals(partials: DataFrame, keys: Sequence[str], totals: Mapping[str, str]) -> DataFrame:
    """Same table as :func:`total_by` of a single measure, from partial sums."""
    ((name, column),) = totals.items()
    merged = _merge(partials.filter(F.col(f"{column}_N") > 0), keys, [f"{column}_SUM"])
    return merged.select(*keys, F.col(f"{column}_SUM").alias(name))


def merge_rates(
    partials: DataFrame, keys: Sequence[str], events: Sequence[str], total: str = "TOTAL_FLIGHTS"
) -> DataFrame:
    """Same table as :func:`rate_by`, from partial counts."""
    merged = _merge(partials, keys, [*[f"{name}_COUNT" for name in events], ROWS])
    return _with_percentages(merged.withColumnRenamed(ROWS, total), keys, events, total)


def merge_counts(partials: DataFrame, keys: Sequence[str], name: str, counted: str) -> DataFrame:
    """Groups with a positive partial count, added up."""
    return _merge(partials.filter(F.col(counted) > 0), keys, [counted]).withColumnRenamed(counted, name)


def mean_of(column: str) -> Column:
    """Mean from a partial sum and count; NULL for an empty group."""
    return F.try_divide(F.col(f"{column}_SUM"), F.col(f"{column}_N"))


def grouped_sets(
    df: DataFrame, grains: Mapping[str, Sequence[str]], all_keys: Sequence[str], measures: Sequence[Column]
) -> DataFrame:
    """GROUPING SETS with the set's name in ``GRAIN``."""
    sets = [[F.col(key) for key in keys] for keys in grains.values()]
    grouped = df.groupingSets(sets, *all_keys).agg(F.grouping_id(*all_keys).alias("_SET"), *measures)
    names = F.create_map(
        *[F.lit(value) for name, keys in grains.items() for value in (_set_number(all_keys, keys), name)]
    )
    measure_names = [c for c in grouped.columns if c not in {*all_keys, "_SET"}]
    return grouped.select(names[F.col("_SET")].alias("GRAIN"), *all_keys, *measure_names)


def distinct_counts(
    df: DataFrame,
    grains: Mapping[str, Sequence[str]],
    many: str,
    few: str,
    names: Sequence[str],
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Exact numbers of distinct values of two columns at several key sets: one of ``many`` values and one of ``few``.

    ``count_distinct`` over GROUPING SETS sends a row for every row and set. Here rows cross one exchange as they are, by
    the value of ``many``. Where the rows of a value meet they are sorted once for each chain of sets that extend each
    other, and a row counts for the sets of which it is the first of its group. Values of ``few`` are folded there by all
    keys of sets that extend each other, and counted from that. ``derived`` keys follow from other columns and are worked
    out behind the exchange. A group without a value of either column has no row.
    """
    keys, derived = _all_keys(grains), derived or {}
    rows = df.repartition(many).withColumns(derived).select(*keys, many, few)
    for number, chain in enumerate(_chains(grains)):
        order = list(dict.fromkeys(key for grain in chain for key in grains[grain]))
        before, placed = f"_before{number}", F.struct(F.lit(True).alias("_row"), *order)
        rows = rows.withColumn(before, F.lag(placed).over(Window.partitionBy(many).orderBy(*(order or [F.lit(True)]))))
        for grain in chain:
            same = F.col(before).isNotNull()
            for key in grains[grain]:
                same = same & F.col(f"{before}.{key}").eqNullSafe(F.col(key))
            rows = rows.withColumn(f"_{grain}", F.col(many).isNotNull() & ~same)
        rows = rows.drop(before)

    types = {c: rows.schema[c].dataType for c in (*keys, few)}

    def at(grain: str, kept: Sequence[str], value: Column | None, n: int) -> Column:
        own = [(F.col(key) if key in kept else F.lit(None).cast(types[key])).alias(key) for key in keys]
        shown = F.lit(None).cast(types[few]) if value is None else value
        return F.struct(F.lit(grain).alias("GRAIN"), *own, shown.alias("_value"), F.lit(n).cast("long").alias("_n"))

    families = _families(grains)
    counted = [F.when(F.col(f"_{grain}"), at(grain, grains[grain], None, 1)) for grain in grains]
    valued = [F.when(F.col(few).isNotNull(), at(own[0], _all_keys({g: grains[g] for g in own}), F.col(few), 0)) for own in families]
    spread = rows.select(F.explode(F.array(*counted, *valued)).alias("_at")).filter(F.col("_at").isNotNull()).select("_at.*")
    folded = spread.groupBy("GRAIN", *keys, "_value").agg(F.sum("_n").alias("_n"))
    # A row with a value stands for all sets of its family, one without for its own set.
    sets = F.array(F.struct("GRAIN", *keys, "_value", "_n"))
    for own in families:
        all_sets = F.array(*[at(grain, grains[grain], F.col("_value"), 0) for grain in own])
        sets = F.when(F.col("_value").isNotNull() & (F.col("GRAIN") == own[0]), all_sets).otherwise(sets)
    found = folded.select(F.explode(sets).alias("_at")).select("_at.*").groupBy("GRAIN", *keys)
    return found.agg(F.sum("_n").alias(names[0]), F.count_distinct("_value").alias(names[1]))


def _chains(grains: Mapping[str, Sequence[str]]) -> list[list[str]]:
    """The sets' names in chains, each set with all keys of the one before it."""
    return _gathered(grains, -1)


def _families(grains: Mapping[str, Sequence[str]]) -> list[list[str]]:
    """The sets' names in groups, each set with all keys of the first of its group."""
    return _gathered(grains, 0)


def _gathered(grains: Mapping[str, Sequence[str]], place: int) -> list[list[str]]:
    found: list[list[str]] = []
    for grain in sorted(grains, key=lambda grain: len(grains[grain])):
        group = next((g for g in found if set(grains[g[place]]) <= set(grains[grain])), None)
        if group is None:
            found.append([grain])
        else:
            group.append(grain)
    return found


def _set_number(all_keys: Sequence[str], keys: Sequence[str]) -> int:
    """Spark's grouping id: one bit per key, set when the key is left out, first key highest."""
    return sum(1 << place for place, key in enumerate(reversed(all_keys)) if key not in keys)


def _merge(partials: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    return partials.groupBy(*keys).agg(*[F.sum(part).alias(part) for part in dict.fromkeys(parts)])


def _all_keys(grains: Mapping[str, Sequence[str]]) -> list[str]:
    return list(dict.fromkeys(key for keys in grains.values() for key in keys))


def _parts(means: Sequence[str], totals: Sequence[str], events: Mapping[str, Column] | None) -> list[Column]:
    parts = [F.count("*").alias(ROWS)]
    for column in dict.fromkeys([*means, *totals]):
        parts += [F.sum(column).alias(f"{column}_SUM"), F.count(column).alias(f"{column}_N")]
    for name, condition in (events or {}).items():
        parts.append(F.count_if(condition).alias(f"{name}_COUNT"))
    return parts


def _added_up(partials: DataFrame) -> list[Column]:
    parts = [c for c in partials.columns if c == ROWS or c.endswith(("_SUM", "_N", "_COUNT"))]
    return [F.sum(part).alias(part) for part in parts]
