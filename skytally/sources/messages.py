"""JSON messages: read from a stream, built from rows, parsed back to columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions.keys import payload_id, position_id
from skytally.schemas import WIRE_NUMBERS, WIRE_SCHEMA, ZERO_DEFAULT_COLUMNS

# Full precision and NULL fields written out: a message keeps all its row's fields.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def kafka_options(servers: str, topic: str, starting: str = "earliest") -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}


def kafka_writer_options(servers: str, topic: str) -> dict[str, str]:
    """A message counts as sent when all replicas have it; a failed send is tried again."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.retries": "5"}


def message_stream(spark: SparkSession, fmt: str, options: Mapping[str, str] | None = None, path: str | None = None) -> DataFrame:
    """Unbounded messages with their text in ``value`` and a repeatable ``id``.

    A ``kafka`` source identifies a message by topic, partition and offset. A
    ``text`` folder has one message per line and no such position, so the id is
    a digest of the line.
    """
    stream = spark.readStream.format(fmt).options(**(options or {}))
    loaded = stream.load(path) if path else stream.load()
    return identified(loaded)


def identified(messages: DataFrame) -> DataFrame:
    """``value`` as text plus ``id``, from whatever columns the source has."""
    if {"topic", "partition", "offset"} <= set(messages.columns):
        key = position_id(F.col("topic"), F.col("partition"), F.col("offset"))
    else:
        key = payload_id(F.col("value"))
    return messages.select(F.col("value").cast("string").alias("value"), key.alias("id"))


def parse_messages(
    messages: DataFrame,
    schema: T.StructType = WIRE_SCHEMA,
    corrupt_column: str | None = None,
    unknown_column: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Typed columns of the JSON in ``value``; columns other than ``value`` are kept.

    With ``columns`` only these fields of the schema are converted, as a scan reads only the columns that are asked
    for; the others are passed over. Every message is still read to its end.

    Parsing is permissive: a bad token gives NULL, an unreadable message a row
    of NULLs. ``corrupt_column`` keeps the text of such a message and
    ``unknown_column`` lists field names that the schema does not declare.
    """
    rest = [c for c in messages.columns if c != "value"]
    options = dict(JSON_OPTIONS)
    target = schema if columns is None else T.StructType([schema[c] for c in columns])
    if corrupt_column:
        target = T.StructType([*target.fields, T.StructField(corrupt_column, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_column
    found = [F.from_json("value", target, options).alias("_data")]
    if unknown_column:
        declared = F.array(*[F.lit(name) for name in schema.names])
        found.append(F.array_except(F.json_object_keys("value"), declared).alias(unknown_column))
    extra = [unknown_column] if unknown_column else []
    return messages.select(*rest, *found).select("_data.*", *rest, *extra)


def to_messages(df: DataFrame) -> DataFrame:
    """One JSON object per row in ``value``."""
    return df.select(F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"))


def typed_rows(
    raw: DataFrame,
    fill: bool = False,
    numbers: Sequence[str] = tuple(WIRE_NUMBERS),
    zero_defaults: Sequence[str] = tuple(ZERO_DEFAULT_COLUMNS),
) -> DataFrame:
    """Raw text with its numeric fields as doubles; empty fields are NULL.

    With ``fill``, empty delay fields become 0.0 and empty text fields empty
    strings. Only an empty delay is filled: text that is no number stays NULL.
    """
    numeric, zeros = set(numbers), set(zero_defaults)

    def typed(name: str) -> str:
        number = f"try_cast(`{name}` AS DOUBLE)"
        if fill and name in zeros:
            return f"CASE WHEN coalesce(`{name}`, '') = '' THEN 0D ELSE {number} END"
        if name in numeric:
            return number
        return f"coalesce(`{name}`, '')" if fill else f"`{name}`"

    return raw.selectExpr(*[f"{typed(c)} AS `{c}`" for c in raw.columns])
