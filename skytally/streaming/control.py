"""Start, await and stop streaming queries."""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


@contextmanager
def _setting(spark: SparkSession, key: str, value: object | None) -> Iterator[None]:
    """A session setting for the time of a block; None leaves it alone."""
    if value is None:
        yield
        return
    before = spark.conf.get(key)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def start(
    stream: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    interval: str | None = "30 seconds",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Run ``write_batch`` on every micro-batch.

    ``interval`` is the processing-time trigger; None takes what is there now
    and ends. ``checkpoint`` belongs to this one query and lies on shared storage.

    A query keeps the number of its state partitions for life. It goes by the
    number of keys in state, not by the size of the input, which is folded
    before it gets there; None takes the session's shuffle partitions.
    """
    writer = stream.writeStream.outputMode(mode).foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    with _setting(stream.sparkSession, "spark.sql.shuffle.partitions", state_partitions):
        return writer.trigger(**_trigger(interval)).start()


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def start_files(
    stream: DataFrame, path: str, checkpoint: str, interval: str | None = "30 seconds", state_partitions: int | None = None
) -> StreamingQuery:
    """Append a stream to a Parquet folder that other streams can read: its log names each file once, so a batch that
    runs again does not show twice. Settings as for :func:`start`."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    with _setting(stream.sparkSession, "spark.sql.shuffle.partitions", state_partitions):
        return writer.trigger(**_trigger(interval)).start()


def await_end(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for the query; True if it ended. A failed query raises its error.

    The query is stopped when the wait ends in any way.
    """
    try:
        ended = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
        return True if ended is None else ended
    finally:
        if query.isActive:
            query.stop()


def run_available(
    stream: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Process everything available now and return the finished query with its progress."""
    query = start(stream, write_batch, checkpoint, mode, None, state_partitions)
    await_end(query)
    return query


def await_any(queries: Sequence[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until one of the queries ends or fails, or the time is over; then stop them all.

    Each query is asked in turn, since the session-wide wait also reports
    queries that ended before.
    """
    until = None if timeout is None else time.monotonic() + timeout
    try:
        for query in itertools.cycle(queries):
            if query.awaitTermination(1) or (until is not None and time.monotonic() >= until):
                return
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
