"""Raw text rows to the published table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.functions.calendar import calendar_parts
from skytally.functions.conversion import CONVERSIONS, as_double, as_floats
from skytally.schemas import PUBLISHED_COLUMNS


def project_published(raw: DataFrame, columns: Sequence[tuple[str, str, str]] = tuple(PUBLISHED_COLUMNS)) -> DataFrame:
    """Choose, rename and convert columns.

    Numbers are converted as one array, see :func:`as_floats`.
    """
    numbers = [source for source, _, kind in columns if kind == "float"]
    others = dict.fromkeys(source for source, _, kind in columns if kind != "float")
    floats = [as_floats(numbers).alias("__floats")] if numbers else []
    place = {source: F.col("__floats")[i] for i, source in enumerate(numbers)}
    return raw.select(*others, *floats).select(
        [(place[source] if kind == "float" else CONVERSIONS[kind](F.col(source))).alias(name) for source, name, kind in columns]
    )


def add_derived(df: DataFrame, date: str = "FL_DATE", arrival_delay: str = "ARR_DELAY") -> DataFrame:
    """Calendar parts and the delay flag, which is NULL where the delay is NULL."""
    return df.withColumns(calendar_parts(F.col(date)) | {"IS_DELAY": (F.col(arrival_delay) > 0).cast("int")})


def drop_copies(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows.

    All columns are the key. The partial aggregate in front of the exchange
    folds copies where they are read, so many copies of one row travel as one
    row per task and cannot make a heavy partition.
    """
    return df.dropDuplicates()


def clean(published: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows with a readable date, without copies, with the derived columns.

    The derived columns follow from the others and stay out of the key of the
    aggregate that drops copies. With ``by`` rows meet by these columns and stay
    where they met, so that a table written by them needs no exchange of its own;
    copies are then folded behind the exchange, not in front of it.
    """
    dated = published.filter(F.col("FL_DATE").isNotNull())
    return add_derived(drop_copies(met_by(dated, by) if by else dated))


def met_by(published: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows moved to where they meet by columns. Numbers travel as one array, at half the width they have in a row."""
    numbers = [source for _, source, kind in PUBLISHED_COLUMNS if kind == "float" and source in published.columns and source not in by]
    others = [c for c in published.columns if c not in numbers]
    sent = published.select(*others, F.array(*numbers).alias("__floats")).repartition(*by)
    place = {name: F.col("__floats")[i].alias(name) for i, name in enumerate(numbers)}
    return sent.select([place.get(c, F.col(c)) for c in published.columns])


def normalise(raw: DataFrame) -> DataFrame:
    """The published table of raw rows.

    Copies are judged on published columns only: raw rows that differ in other
    columns count as copies.
    """
    return clean(project_published(raw))


def numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast the named columns to double in place."""
    return df.withColumns({c: as_double(F.col(c).cast("string")) for c in columns})


def required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which all the named columns have a value.

    One condition per column, which Spark can push to the scan one by one;
    ``dropna`` makes a single condition that stays above joins.
    """
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df
