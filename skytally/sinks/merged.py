"""A table of current rows that takes up new micro-batches bucket by bucket.

The table is cut into buckets by a hash of its keys. Taking up batches reads these, and of the table only the buckets
that they touch; those are written anew and a commit file then names, for every bucket, the folder that holds it. Readers
go by the newest commit file, so what was written without a commit does not exist for them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.operators.ranking import latest_per_key
from skytally.sinks.files import children, delete, read_text, write_new
from skytally.sinks.tables import BATCH

BUCKET = "_bucket"
#: Makes one row of the rows of each key.
Fold = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Commit:
    """State of the table: the last batch it has taken up, and the folder of each bucket that holds rows."""

    version: int
    upto: int
    keys: tuple[str, ...]
    buckets: int
    folders: dict[str, str]
    schema: str

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def latest_row(keys: Sequence[str]) -> Fold:
    """The row of the newest batch for each key, as an upserting sink would hold."""
    return lambda rows: latest_per_key(rows, keys, [BATCH])


def summed(keys: Sequence[str], measures: Sequence[str]) -> Fold:
    """Sums of partial counts for each key; ``batch_id`` is that of the last."""
    return lambda rows: rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures], F.max(BATCH).alias(BATCH))


def _commit(spark: SparkSession, file: str) -> Commit:
    fields = json.loads(read_text(spark, file))
    return Commit(**fields | {"keys": tuple(fields["keys"])})


def last_commit(spark: SparkSession, path: str) -> Commit | None:
    names = [n for n in children(spark, f"{path}/commits") if n.endswith(".json")]
    if not names:
        return None
    return _commit(spark, f"{path}/commits/{max(names)}")


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _rows(spark: SparkSession, path: str, commit: Commit, wanted: Sequence[int] | None = None) -> DataFrame:
    chosen = [b for b in commit.folders if wanted is None or int(b) in wanted]
    if not chosen:
        return spark.createDataFrame([], commit.columns)
    return spark.read.schema(commit.columns).parquet(*[f"{path}/data/{commit.folders[b]}/{BUCKET}={b}" for b in chosen])


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its last commit, without the number of the batch a row came from."""
    commit = last_commit(spark, path)
    if commit is None:
        raise ValueError(f"nothing was taken up into {path} yet")
    return _rows(spark, path, commit).drop(BATCH)


def new_batches(spark: SparkSession, batches: str, commit: Commit | None, upto: int | None = None) -> list[int]:
    """Numbers of the finished batch folders that the table has not taken up, in order."""
    done = commit.upto if commit else -1
    found = [int(n.split("=")[1]) for n in children(spark, batches) if n.startswith(f"{BATCH}=")]
    fresh = sorted(n for n in found if n > done and (upto is None or n <= upto))
    for i, number in enumerate(fresh):
        if "_SUCCESS" not in children(spark, f"{batches}/{BATCH}={number}"):
            return fresh[:i]  # it is being written, and those after it have to wait
    return fresh


def merge_batches(
    spark: SparkSession, batches: str, path: str, keys: Sequence[str], fold: Fold | None = None, buckets: int = 64, upto: int | None = None
) -> list[int]:
    """Take new batch folders of ``batches`` up into the table at ``path``; returns the numbers of the buckets written.

    ``fold`` makes one row for each key (:func:`latest_row` by default, or :func:`summed` for partial counts). It is
    applied to the new rows, and to these with the table's rows of the same buckets, so it must not depend on how rows
    are grouped. Columns of batches may be added later; old rows have NULL there. The number of buckets and the keys
    stay as they were at first.

    A batch is taken up once: its number is in the same commit file as the data. If the job dies before it writes that
    file, the table is as before. Two jobs that commit at the same time cannot both succeed.
    """
    commit = last_commit(spark, path)
    fresh = new_batches(spark, batches, commit, upto)
    if not fresh:
        return []
    if commit:
        if tuple(keys) != commit.keys:
            raise ValueError(f"the table's keys are {commit.keys}")
        buckets = commit.buckets
    fold = fold or latest_row(keys)
    arrived = spark.read.option("basePath", batches).option("mergeSchema", True).parquet(*[f"{batches}/{BATCH}={n}" for n in fresh])
    arrived = arrived.withColumn(BATCH, F.col(BATCH).cast("long"))
    touched = sorted(r[0] for r in arrived.select(_bucket(keys, buckets).alias("b")).distinct().collect())
    rows = fold(arrived)
    if commit:
        rows = fold(rows.unionByName(_rows(spark, path, commit, touched), allowMissingColumns=True))
    folder = f"{(commit.version if commit else 0) + 1:08d}-{uuid.uuid4().hex}"
    placed = rows.withColumn(BUCKET, _bucket(keys, buckets))
    placed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/data/{folder}")
    done = Commit(
        version=(commit.version if commit else 0) + 1,
        upto=fresh[-1],
        keys=tuple(keys),
        buckets=buckets,
        folders=(commit.folders if commit else {}) | {str(b): folder for b in touched},
        schema=rows.schema.json(),
    )
    write_new(spark, f"{path}/commits/{done.version:08d}.json", json.dumps(done.__dict__))
    return touched


def remove_old(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete folders that none of the last ``keep`` commits names, and older commit files; returns their number.

    Readers of the last ``keep`` commits are not disturbed. Do not run it while batches are taken up.
    """
    names = sorted(n for n in children(spark, f"{path}/commits") if n.endswith(".json"))
    kept = [_commit(spark, f"{path}/commits/{n}") for n in names[-keep:]]
    used = {folder for commit in kept for folder in commit.folders.values()}
    gone = [f"{path}/data/{n}" for n in children(spark, f"{path}/data") if n not in used]
    gone += [f"{path}/commits/{n}" for n in names[:-keep]]
    for each in gone:
        delete(spark, each)
    return len(gone)
