"""Near-duplicate embeddings: random-hyperplane sign hashing, exact cosine, connected components.

Equal vectors of a label are one class. In each of several tables a class falls into the bucket that the signs of its
products with random hyperplanes name. Classes that share a bucket are compared by exact cosine in blocks of bounded
size; a pair that shares several buckets counts in the first table only, so link counts are those of distinct pairs.
A block returns one row per class: its links there and one edge to the class it is connected with.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.components import components
from skytally.llm.rows import NO_ID
from skytally.session import stage

#: Classes of a bucket that meet in one task, in each of the two blocks that are compared.
BLOCK = 1024
#: Chance that a pair just similar enough shares no bucket.
MISS = 1e-6
SEED = 20


def plan(n: int, threshold: float) -> tuple[int, int]:
    """Bits of a bucket's name and number of tables for ``n`` vectors.

    Bits grow with the logarithm of ``n``, which holds the number of unrelated vectors in a bucket constant; tables
    make up for the pairs that more bits part.
    """
    bits = max(6, math.ceil(math.log2(max(n, 2))))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - together))


def _codes(rows: DataFrame, bits: int, tables: int, kind: str) -> DataFrame:
    """``cls`` and ``codes``: the names of the class's buckets, one 64-bit number for each table, as bytes."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = np.left_shift(np.uint64(1), np.arange(bits, dtype=np.uint64))
        for batch in batches:
            out = []
            for data in batch.column(1).to_pylist():
                x = np.frombuffer(data, kind).astype(np.float64)
                if len(x) not in planes:
                    planes[len(x)] = np.random.default_rng([SEED, len(x)]).standard_normal((tables * bits, len(x)))
                above = (planes[len(x)] @ x > 0).reshape(tables, bits)
                out.append((above * weights).sum(axis=1, dtype=np.uint64).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["cls", "codes"])

    return rows.select("cls", "data").mapInArrow(sign, "cls long, codes binary")


def _segments(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[list[pa.RecordBatch]]:
    """Runs of rows with equal values in the first ``n_keys`` columns, of sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(keys[:, a])
            if held and key != last:
                yield held
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield held


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node each of ``n`` nodes reaches by the edges ``a``, ``b``."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def _links(members: DataFrame, threshold: float, kind: str) -> DataFrame:
    """``cls``, ``n`` (vectors linked with it here, first found in this table), ``root`` (a class it is connected with)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = 0

        def batch_of() -> pa.RecordBatch:
            arrays = [pa.array(np.concatenate(x), pa.int64()) for x in zip(*out, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["cls", "n", "root"])

        for run in _segments(batches, 6):
            size = sum(b.num_rows for b in run)
            if size < 2:
                continue
            whole = pa.Table.from_batches(run).combine_chunks()
            t, low, high = (whole.column(i)[0].as_py() for i in (2, 4, 5))
            block, cls, mult = (whole.column(i).to_numpy() for i in (6, 7, 8))
            x = np.frombuffer(b"".join(whole.column(9).to_pylist()), kind).reshape(size, -1).astype(np.float64)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            codes = np.frombuffer(b"".join(whole.column(10).to_pylist()), "<u8").reshape(size, -1)[:, :t]
            left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
            if not len(left) or not len(right):  # by chance no member has the block's number
                continue
            found_a, found_b = [], []
            for i in range(0, len(left), 256):
                some = left[i : i + 256]
                a, b = np.nonzero(x[some] @ x[right].T >= threshold)
                a, b = some[a], right[b]
                if low == high:
                    a, b = a[a < b], b[a < b]
                new = ~(codes[a] == codes[b]).any(axis=1)
                found_a.append(a[new])
                found_b.append(b[new])
            a, b = np.concatenate(found_a), np.concatenate(found_b)
            if not len(a):
                continue
            n = np.bincount(a, mult[b], size) + np.bincount(b, mult[a], size)
            linked = n > 0
            out.append((cls[linked], n[linked].astype(np.int64), cls[_roots(size, a, b)[linked]]))
            rows += int(linked.sum())
            if rows >= 10_000:
                yield batch_of()
                out.clear()
                rows = 0
        if out:
            yield batch_of()

    keys = ["label", "dim", "t", "code", "low", "high"]
    dealt = members.select(*keys, "block", "cls", "mult", "data", "codes").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(compare, "cls long, n long, root long")


def link_vectors(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per vector: its id, ``n_links`` (other vectors linked), ``component_id`` (smallest id reachable), ``kept``.

    Vectors of equal labels (of any type) are linked if their cosine in double precision is at least ``threshold``. Vectors that are
    NULL, empty or zero, hold a NULL, NaN or infinite component, or have a NULL label link with nothing, vectors of
    different length not with each other. A repeated row is another vector. A NULL id counts as larger than all; it is
    kept only if it links with nothing. A pair at the threshold is missed with a chance of :data:`MISS`. An empty table
    gives an empty table.

    All linked vectors that share a bucket are compared, since each needs its number of links: a group of n vectors
    that differ but are all similar costs n^2 / 2 products, in blocks dealt over all tasks.
    """
    element = vectors.schema[vector_col].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    x = F.col(vector_col)
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    usable = x.isNotNull() & F.col(label_col).isNotNull() & ~F.exists(x, bad) & F.exists(x, lambda v: v != 0)
    narrow = vectors.select(
        F.col(id_col).alias("id"),
        F.coalesce(usable, F.lit(False)).alias("usable"),
        F.xxhash64(label_col, vector_col).alias("h1"),
        F.xxhash64(F.lit(SEED), label_col, vector_col).alias("h2"),
        F.xxhash64(label_col).alias("label"),  # of any type
        x.alias("x"),
    )
    narrow = narrow.withColumn("id", F.coalesce(F.col("id").cast("long"), F.lit(NO_ID)))

    def scaled(v: np.ndarray) -> np.ndarray:
        """By a power of two, which changes no cosine, so that squares of double components stay in range."""
        return np.ldexp(v, -np.frexp(np.abs(v).max())[1]) if v.dtype == np.float64 and len(v) else v

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [None if v is None else scaled(np.array(v, kind)).tobytes() for v in batch.column(5).to_pylist()]
            dims = [None if v is None else len(v) for v in batch.column(5).to_pylist()]
            columns = [batch.column(i) for i in range(5)] + [pa.array(dims, pa.int64()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "usable", "h1", "h2", "label", "dim", "data"])

    schema = "id long, usable boolean, h1 long, h2 long, label long, dim long, data binary"
    rows = stage(narrow.withColumn("x", F.when(F.col("usable"), F.col("x"))).mapInArrow(pack, schema), "vectors")
    same = rows.where("usable").groupBy("label", "h1", "h2")
    classes = same.agg(F.count("*").alias("mult"), F.first("dim").alias("dim"), F.first("data").alias("data"))
    classes = stage(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")

    bits, tables = plan(classes.count(), threshold)
    codes = stage(_codes(classes, bits, tables, kind), "vector-codes")
    split = classes.select("cls", "label", "dim").join(codes, "cls")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            code = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<i8")
            each = np.repeat(np.arange(n), tables)
            columns = [batch.column(i).take(pa.array(each)) for i in range(3)]
            columns += [pa.array(np.tile(np.arange(tables), n), pa.int32()), pa.array(code, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["cls", "label", "dim", "t", "code"])

    named = split.mapInArrow(spread, "cls long, label long, dim long, t int, code long")
    bucket = ["label", "dim", "t", "code"]
    sizes = named.groupBy(*bucket).agg(F.count("*").alias("size")).where("size > 1")
    # A large bucket is cut into blocks, and each member goes to every pair of blocks that has its own.
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    members = named.join(sizes.withColumn("blocks", blocks), bucket)
    members = members.withColumn("block", F.pmod(F.xxhash64("cls", "t"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    payload = classes.select("cls", "mult", "data").join(codes, "cls")
    found = stage(_links(members.join(payload, "cls"), threshold, kind), "vector-links")

    counts = found.groupBy("cls").agg(F.sum("n").alias("n"))
    joined = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    per_class = classes.select("label", "h1", "h2", "cls", "mult").join(counts, "cls", "left")
    per_class = per_class.join(joined.withColumnRenamed("node", "cls"), "cls", "left")
    per_class = per_class.select(
        "label",
        "h1",
        "h2",
        (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
        F.coalesce("component", "cls").alias("component"),
    )
    owned = rows.select("id", "usable", "label", "h1", "h2").where("usable").join(per_class, ["label", "h1", "h2"])
    owned = stage(owned.select("id", "n_links", "component"), "vector-components")
    least = owned.groupBy("component").agg(F.min("id").alias("component_id"))
    good = owned.join(least, "component").select("id", "n_links", "component_id")
    alone = rows.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = good.unionByName(alone).withColumn("kept", F.col("id") == F.col("component_id"))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).cast("long")
    return out.select(real("id").alias(id_col), "n_links", real("component_id").alias("component_id"), "kept")
