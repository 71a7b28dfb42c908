"""Row keys and the rewriting of a text column, shared by the operators on documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a NULL id counts as: larger than any other, so such a row never is the one that is kept for others.
NO_ID = (1 << 63) - 1


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Adds ``__did``, the id to order by, and ``__row``, a hash of id and text. Repeated rows share both."""
    return docs.withColumns(
        {"__did": F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), "__row": F.xxhash64(id_col, text_col)}
    )


def matching(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose id and ``row_hash`` (of id and text) are in ``chosen``."""
    some = chosen.select(F.col(id_col).alias("__id"), F.col("row_hash").alias("__hash"))
    hashed = docs.withColumn("__row", F.xxhash64(id_col, text_col))
    same = hashed["__row"].eqNullSafe(some["__hash"]) & hashed[id_col].eqNullSafe(some["__id"])
    return hashed.join(some, same, "left_semi").drop("__row")


def binary(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; NULL is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def rewrite(
    docs: DataFrame,
    text_col: str,
    fields: dict[str, str],
    using: list[str],
    function: Callable[[dict[str, list], list[bytes]], tuple[list[bytes], list[list]]],
) -> DataFrame:
    """``docs`` with the text replaced and number columns added, whole batches at a time.

    ``function`` gets the columns of ``using`` as lists and the texts as UTF-8; it returns the new texts and one list
    for each entry of ``fields`` (name to type). The columns of ``using`` are dropped, those named in ``fields`` replaced.
    """
    taken = {c.lower() for c in (*fields, *using)}
    rest = [c for c in docs.columns if c.lower() not in taken]
    ordered = docs.select(*rest, *using)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in ordered.schema.fields[: len(rest)]])
    schema[text_col].dataType = T.StringType()
    for name, kind in fields.items():
        schema = schema.add(name, kind)
    at = rest.index(text_col)
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    types = [kinds[k] for k in fields.values()]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = {name: batch.column(len(rest) + i).to_pylist() for i, name in enumerate(using)}
            texts, numbers = function(values, binary(batch.column(at)))
            columns = [batch.column(i) for i in range(len(rest))]
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            columns += [pa.array(x, t) for x, t in zip(numbers, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return ordered.mapInArrow(run, schema)
