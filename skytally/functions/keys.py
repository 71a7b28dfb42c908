"""Identifiers that come out the same when a task or micro-batch is run again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# Stands for a missing key part: a document id must not be NULL.
MISSING = "(none)"


def single_id(column: str) -> Column:
    """A key as its own document id."""
    return F.coalesce(F.col(column).cast("string"), F.lit(MISSING))


def joined_id(columns: Sequence[str], separator: str = "-") -> Column:
    """Readable id of several key parts.

    Two keys can read the same when a part holds the separator. Use
    :func:`safe_id` where the id must be unique.
    """
    parts = []
    for column in columns:
        parts += [F.lit(separator), single_id(column)]
    return F.concat(*parts[1:])


def safe_id(columns: Sequence[str]) -> Column:
    """Unique id of several key parts: a JSON array, in which NULL and text differ."""
    return F.to_json(F.array(*[F.col(c).cast("string") for c in columns]), {"ignoreNullFields": "false"})


def payload_id(payload: Column) -> Column:
    """Digest of the message text: equal messages share an id."""
    return F.sha2(payload.cast("string"), 256)


def position_id(topic: Column, partition: Column, offset: Column) -> Column:
    """Place of the message in its source: every message has its own id."""
    return F.concat_ws(":", topic, partition.cast("string"), offset.cast("string"))


def value_hash(columns: Sequence[str], salt: str = "") -> Column:
    """Signed 64-bit hash of the row's own values.

    It does not depend on partitioning, so a recomputed task keeps its rows.
    """
    return F.xxhash64(F.lit(salt), *columns)


def portable_hash(columns: Sequence[str], salt: str = "") -> Column:
    """32-bit hash (0 to 2^32 - 1), for use where another engine has to agree.

    It takes MD5 over a JSON array of the values as text, which costs more.
    """
    values = F.to_json(F.array(F.lit(salt), *[F.col(c).cast("string") for c in columns]), {"ignoreNullFields": "false"})
    return F.conv(F.substring(F.md5(values), 1, 8), 16, 10).cast("bigint")
