"""Windowed counts that keep late rows: sums of partial counts by micro-batch.

Every micro-batch folds its rows to one partial per window and key and writes them to a folder of its own, those of windows
that had closed before the batch apart from the others. Counts are sums of partials, so windows as they were when they
closed, corrections that came later, and the whole are three views of the same folders. No row is dropped, no state is
kept between batches, and a batch that runs again replaces its folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions.calendar import EPOCH
from skytally.sinks.tables import BATCH, read_batches

PROGRESS = T.StructType().add("newest", T.TimestampNTZType()).add("closed", T.TimestampNTZType())
LATE, ON_TIME = "late", "on_time"


def _interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def partial_counts(rows: DataFrame, moment: str, keys: Sequence[str], width: str, name: str = "n") -> DataFrame:
    """``window_start``, ``window_end``, the keys, a count and the ``newest`` moment. Rows without one share a window without bounds."""
    known = F.coalesce(F.col(moment), F.expr(EPOCH))
    dated = F.col(moment).isNotNull().alias("_dated")
    folded = rows.groupBy(F.window(known, width).alias("_w"), dated, *keys)
    folded = folded.agg(F.count("*").alias(name), F.max(moment).alias("newest"))
    bounds = [F.when(F.col("_dated"), F.col(f"_w.{b}")).alias(f"window_{b}") for b in ("start", "end")]
    return folded.select(*bounds, *keys, name, "newest")


def late_counts_writer(
    path: str, moment: str, keys: Sequence[str], width: str, lateness: str, name: str = "n"
) -> Callable[[DataFrame, int], None]:
    """Micro-batch callback that writes the partial counts of a batch, late ones apart.

    A window is closed for a batch when the newest moment of all earlier batches lies ``lateness`` or more behind its
    end. ``moment`` is without zone. What the next batch has to know is one row, written last: a batch that fails before
    that runs again with the same bounds.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _progress(spark, path, batch_id - 1)
        newest_before, closed = before if before else (None, None)
        partials = partial_counts(batch, moment, keys, width, name)
        late = F.coalesce(F.col("window_end") <= F.lit(closed).cast("timestamp_ntz"), F.lit(False))
        output = partials.withColumn("part", F.when(late, LATE).otherwise(ON_TIME))
        folder = f"{path}/partials/{BATCH}={batch_id}"
        output.write.mode("overwrite").partitionBy("part").parquet(folder)
        written = spark.read.schema(T.StructType(PROGRESS.fields[:1])).parquet(folder)
        newest = F.greatest(F.max("newest"), F.lit(newest_before).cast("timestamp_ntz")).alias("newest")
        progress = written.agg(newest).select("newest", (F.col("newest") - _interval(lateness)).alias("closed"))
        progress.write.mode("overwrite").parquet(f"{path}/progress/{BATCH}={batch_id}")

    return write


def _progress(spark: SparkSession, path: str, batch_id: int) -> tuple | None:
    """What the batch before has left; None before the first."""
    if batch_id < 0:
        return None
    return tuple(spark.read.schema(PROGRESS).parquet(f"{path}/progress/{BATCH}={batch_id}").first())


def partials_schema(keys: T.StructType, name: str = "n") -> T.StructType:
    fields = [T.StructField(f"window_{b}", T.TimestampNTZType()) for b in ("start", "end")]
    # Names and order as written; the part is the name of a folder.
    return T.StructType([*fields, *keys.fields, T.StructField(name, T.LongType()), T.StructField("part", T.StringType())])


def read_partials(spark: SparkSession, path: str, keys: T.StructType, name: str = "n") -> DataFrame:
    """All partials with ``part`` (``late`` or ``on_time``) and their batch."""
    return read_batches(spark, f"{path}/partials", partials_schema(keys, name))


def counts_with_late(partials: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Per window and key the count of all rows, of those in time and of late ones: ``name``, ``on_time`` and ``late``."""
    of = lambda part: F.coalesce(F.sum(F.when(F.col("part") == part, F.col(name))), F.lit(0)).alias(part)
    summed = partials.groupBy("window_start", "window_end", *keys)
    return summed.agg(F.sum(name).alias(name), of(ON_TIME), of(LATE))


def closed_windows(partials: DataFrame, closed: Column, keys: Sequence[str], name: str = "n") -> DataFrame:
    """The windows that end by ``closed``, as they were when they closed: late rows are left to :func:`corrections`."""
    final = partials.filter((F.col("part") == ON_TIME) & (F.col("window_end") <= closed))
    return final.groupBy("window_start", "window_end", *keys).agg(F.sum(name).alias(name))


def corrections(partials: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """What late rows add to closed windows, by the batch they came in: to be added to what was taken before."""
    late = partials.filter(F.col("part") == LATE)
    return late.groupBy("window_start", "window_end", *keys, BATCH).agg(F.sum(name).alias(name))


def closed_by(spark: SparkSession, path: str) -> Column:
    """The moment up to which windows are closed after the last batch; NULL if nothing was written."""
    latest = read_batches(spark, f"{path}/progress", PROGRESS).agg(F.max("closed")).first()[0]
    return F.lit(latest).cast("timestamp_ntz")
