"""Contiguous shards of near-equal size.

Rows are laid out in id order by range partitioning. Every partition reports
its bytes and rows, a prefix sum over those few totals places each partition,
and a running sum inside the partition places each row. The row whose middle
byte lies in the i-th of ``n`` equal stretches of the whole goes to shard i.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skytally.session import stage


def text_size(text: Column, overhead: int = 16) -> Column:
    """UTF-8 bytes of a text (NULL: none) and a fixed overhead for each row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long")


def shard_by_bytes(rows: DataFrame, id_col: str, size: Column, n_shards: int) -> DataFrame:
    """Columns of ``rows`` with ``size``, ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    ``size`` is any positive whole number. Shards are contiguous in the order of ``id_col``,
    NULL first; rows with equal ids keep the order in which they were read. A shard differs
    from its target by less than the largest row. Columns named ``size``, ``shard`` or ``slot``
    are replaced. An empty table gives an empty table.
    """
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c.lower() not in ("size", "shard", "slot")]
    inner = rows.select(
        F.struct(*columns).alias("row"),
        F.col(id_col).alias("id"),
        size.cast("long").alias("size"),
        F.monotonically_increasing_id().alias("read"),  # tells equal ids apart
    )
    inner = stage(inner, "shard-rows")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = inner.repartitionByRange(parts, "id", "read").withColumn("part", F.spark_partition_id())
    placed = stage(placed, "shard-ranges")

    # One row per partition: its number is bounded by the setting above.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        placed.groupBy("part")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .select(
            "part",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
        )
    )
    inside = Window.partitionBy("part").orderBy("id", "read").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = placed.select(
        "*", F.sum("size").over(inside).alias("bytes_here"), F.row_number().over(inside).alias("rows_here")
    ).join(F.broadcast(totals), "part")
    # The middle of the row, doubled to stay whole, as a share of the whole.
    shard = F.expr(f"((2 * (bytes_before + bytes_here) - size) * {int(n_shards)}) div (2 * all_bytes)")
    numbered = numbered.select(
        "row", "size", (F.col("rows_before") + F.col("rows_here") - 1).alias("at"), shard.cast("int").alias("shard")
    )
    first = numbered.groupBy("shard").agg(F.min("at").alias("first"))  # one row per shard
    return numbered.join(F.broadcast(first), "shard").select(
        "row.*", "size", "shard", (F.col("at") - F.col("first")).alias("slot")
    )
