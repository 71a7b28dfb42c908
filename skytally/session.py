"""Session settings and the shared work folder."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning, skew splitting and off-heap streaming state are what the
# operators rely on. HotSpot does not compile methods above 8000 bytes of
# bytecode, so wider generated code (the 35-column projection) is split instead.
# Sizes are left to the cluster's own configuration and to ``sized_for``.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; ``conf`` entries win. Keys use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master, whose executors share this machine, may fall back to
    the warehouse. A cluster without the setting is a configuration error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


@functools.cache
def _session_folder(shared: str, application: str) -> str:
    """Folder of one application, which the file system removes when the application ends."""
    spark = SparkSession.active()
    folder = f"{shared}/skytally/{application}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return folder


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing folder below the shared folder. It is removed when the application ends."""
    return f"{_session_folder(shared_folder(spark), spark.sparkContext.applicationId)}/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table that several later jobs read to the shared folder, and read it back.

    Unlike cached blocks it outlives the executors, and it cuts the lineage.
    """
    folder = work_folder(df.sparkSession, purpose)
    df.write.partitionBy(*partition_by).parquet(folder)
    return df.sparkSession.read.parquet(folder)


@contextmanager
def staged(df: DataFrame, purpose: str, partition_by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """Like :func:`stage`, for the time of a block: the table is removed at its end."""
    spark = df.sparkSession
    folder = work_folder(spark, purpose)
    try:
        df.write.partitionBy(*partition_by).parquet(folder)
        yield spark.read.parquet(folder)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_MIB = 1 << 20


def sizing(input_bytes: int) -> dict[str, int]:
    """Split size, shuffle partitions and size of written files for a job that reads so many bytes.

    Splits grow only when there would be more than 100,000 of them, up to
    1 GiB; a shuffle partition takes what came from 512 MiB of input, or from
    one split if that is more. At 100 TB both numbers are about 100,000, which
    keeps the driver's map of shuffle blocks in memory. The advised size is
    what a rebalanced write gathers for one file; it grows for the same reason.
    """
    split = min(max(128 * _MIB, -(-input_bytes // 100_000)), 1024 * _MIB)
    return {
        "spark.sql.files.maxPartitionBytes": split,
        "spark.sql.shuffle.partitions": -(-input_bytes // max(512 * _MIB, split)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": min(max(64 * _MIB, input_bytes // 40_000), 512 * _MIB),
    }


# Removes the files of a query's exchanges when it ends, not when its objects are collected.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_exchanges(spark: SparkSession) -> Iterator[None]:
    """The files of exchanges are removed with the end of each query that runs in a block, such as a write."""
    before = spark.conf.get(_FREED)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int, packed: int = 1) -> Iterator[None]:
    """Settings of at least :func:`sizing` for the time of a block; larger ones stay, and all are put back after it.

    A byte of compressed files holds ``packed`` bytes of text; their splits are smaller by that, so that a task has no more rows.
    """
    before: dict[str, str] = {}
    for key, value in sizing(input_bytes).items():
        current = spark.conf.get(key)
        now = int(current[:-1]) if current.endswith("b") and current[:-1].isdigit() else current
        if packed > 1 and key == "spark.sql.files.maxPartitionBytes":
            value //= packed
        elif not str(now).isdigit() or int(now) >= value:
            continue
        before[key] = current
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
