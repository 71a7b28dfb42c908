"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard similarity, connected components.

1. A document's set of word shingles gets a signature from two permutations: the first scatters the shingles, the
   second, shifted circularly by one more place for each coordinate, orders them; a coordinate is the least number.
2. Documents with equal sets are one class. Bands of coordinates name the buckets a class falls into.
3. In each bucket every class is compared with the bucket's first on the full sets; distinct pairs only.
4. Buckets whose classes are still in several components are compared whole, in blocks of bounded size that return
   edges between components, not pairs. So no two classes that share a bucket go unexamined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.components import components
from skytally.llm.embed_dedup import _roots, _segments
from skytally.llm.rows import NO_ID, binary, keyed, matching
from skytally.llm.words import ODD, WordHashes, mix, run_hashes
from skytally.session import stage

#: Coordinates of a band.
ROWS = 5
#: Chance that a pair just similar enough shares no band.
MISS = 1e-6
#: Classes compared with one first class, or with each other, in one go.
BLOCK = 256
STAR = 512


def shingles(text: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct numbers of the text's runs of ``size`` words; of all its words together if they are fewer."""
    words = hashes.of(text.lower().split())
    if not len(words):
        return words
    if len(words) < size:
        return run_hashes(words, len(words)) + np.uint64(len(words))
    return np.unique(run_hashes(words, size))


def signature(members: np.ndarray, n: int) -> np.ndarray:
    """``n`` coordinates of the circulant MinHash over the universe of 32-bit numbers."""
    first = (mix(members) >> np.uint64(32)).astype(np.uint32)
    shift = np.arange(1, n + 1, dtype=np.uint32)[:, None]
    out = np.full(n, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(first), 1024):
        x = first[None, i : i + 1024] - shift
        for right, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):  # a bijection of 32-bit numbers: the permutation
            x ^= x >> np.uint32(right)
            x *= np.uint32(factor)
        x ^= x >> np.uint32(16)
        np.minimum(out, x.min(axis=1), out=out)
    return out


def plan(percent: int) -> int:
    """Number of bands: a pair of that similarity misses one with 1 - similarity^ROWS, and all of them with ``MISS`` at most."""
    if not 0 < percent <= 100:
        raise ValueError(f"no similarity to look for: {percent} percent")
    together = (percent / 100) ** ROWS
    return math.ceil(math.log(MISS) / math.log(1 - together)) if together < 1 else 1


def band_codes(coordinates: np.ndarray) -> np.ndarray:
    code = np.zeros(len(coordinates) // ROWS, dtype=np.uint64)
    for column in coordinates.reshape(-1, ROWS).T:
        code = mix(code * ODD + column)
    return code


def _similar(common: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (a + b - common)


def _signed(docs: DataFrame, size: int, bands_of: int) -> DataFrame:
    """``__did``, ``__row``, ``n``, ``k1``, ``k2`` (hash of the set, NULL if empty), ``bands``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            known: dict[bytes, np.ndarray] = {}
            n, keys, bands = [], [], []
            for text in binary(batch.column(2)):
                members = shingles(text, size, hashes)
                n.append(len(members))
                if not len(members):
                    keys.append((None, None))
                    bands.append(None)
                    continue
                key = xxhash.xxh3_128_digest(members)
                if key not in known:
                    known[key] = band_codes(signature(members, bands_of * ROWS)).view(np.int64)
                keys.append(tuple(np.frombuffer(key, "<i8").tolist()))
                bands.append(known[key])
            columns = [pa.array(n, pa.int64()), *(pa.array(k, pa.int64()) for k in zip(*keys, strict=True))]
            columns.append(pa.array(bands, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names)

    names = ["__did", "__row", "n", "k1", "k2", "bands"]
    return docs.select("__did", "__row", "__text").mapInArrow(
        sign, "__did long, __row long, n long, k1 long, k2 long, bands array<long>"
    )


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """``cls`` and ``members``, the sorted shingles as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            out = [shingles(t, size, hashes).tobytes() for t in binary(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["cls", "members"])

    return texts.select("cls", "__text").mapInArrow(run, "cls long, members binary")


def _star_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (``a``, ``b``) that are similar. A first class with many others is copied to several tasks."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).cast("int").alias("parts"))
    others = pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b")
    firsts = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    own, other = sets.withColumnRenamed("cls", "a"), sets.withColumnRenamed("cls", "b")
    rows = (
        firsts.join(own, "a")
        .select("a", "part", F.lit(-1).cast("long").alias("b"), "members")
        .union(others.join(other, "b").select("a", "part", "b", "members"))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, mine = None, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            found = []
            for a, b, members in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                x = np.frombuffer(members, np.uint64)
                if b < 0:
                    first, mine = a, x
                elif a == first:
                    at = np.searchsorted(mine, x)
                    common = int((mine[np.minimum(at, len(mine) - 1)] == x).sum())
                    if _similar(common, len(mine), len(x), percent):
                        found.append((a, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

    near = rows.repartition("a", "part").sortWithinPartitions("a", "part", "b")
    return near.mapInArrow(compare, "a long, b long")


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Number of common members of every two sets, by products of parts of the membership matrix."""
    n = len(sets)
    values, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = count > 1
    place = np.cumsum(shared) - 1
    use = shared[inverse]
    owner, column = owner[use], place[inverse[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((n, n), dtype=np.float32)
    width = 2048
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, (low, low + width))
        matrix = np.zeros((n, width), dtype=np.float32)
        matrix[owner[a:b], column[a:b] - low] = 1
        out += matrix @ matrix.T
    return out


def _block_links(members: DataFrame, percent: int) -> DataFrame:
    """Edges (``a``, ``b``) that connect what is similar within each pair of blocks of a bucket."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _segments(batches, 4):
            whole = pa.Table.from_batches(run)
            if whole.num_rows < 2:
                continue
            cls = whole.column("cls").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in whole.column("members").to_pylist()]
            size = np.array([len(s) for s in sets], dtype=np.float64)
            a, b = np.nonzero(np.triu(_similar(_common(sets), size[:, None], size[None, :], percent), 1))
            if len(a):
                root = _roots(len(cls), a, b)
                joined = root != np.arange(len(cls))
                arrays = [pa.array(cls[root[joined]], pa.int64()), pa.array(cls[joined], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["a", "b"])

    keys = ["t", "code", "low", "high"]
    dealt = members.select(*keys, "cls", "members").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, percent: int = 85, size: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id, ``n_shingles``, ``component_id``, ``kept``, ``row_hash`` (of id and text), ``first``.

    Words are runs of other characters than ASCII white space, A-Z in lower case. Two documents are linked if the
    intersection of their sets of ``size``-word shingles is at least ``percent`` percent of the union; a component's id
    is the smallest document id in it. Fewer words than ``size`` are one shingle; a text without words, or NULL, has
    none and is linked with nothing. A repeated row is in the component of its like, with the same id. A NULL id counts
    as larger than all others and reads NULL. Of kept rows of a component, which have equal or no ids, the one with the
    least row hash is ``first``. An empty table gives an empty table. Shingles are 64-bit hashes.
    """
    known = keyed(docs, id_col, text_col).select("__did", "__row", F.col(text_col).alias("__text"))
    rows = stage(_signed(known, size, plan(percent)), "shingle-sets")
    classes = rows.where("k1 IS NOT NULL").groupBy("k1", "k2")
    classes = classes.agg(
        F.min(F.struct("__did", "__row")).alias("doc"), F.first("n").alias("n"), F.first("bands").alias("bands")
    ).select("k1", "k2", "doc.*", "n", "bands", F.monotonically_increasing_id().alias("cls"))
    classes = stage(classes, "shingle-classes")

    named = classes.select("cls", "n", F.posexplode("bands").alias("t", "code"))
    buckets = named.groupBy("t", "code").agg(F.count("*").alias("size"), F.min(F.struct("cls", "n")).alias("first"))
    first = buckets.where("size > 1").select("t", "code", "size", F.col("first.cls").alias("a"), F.col("first.n").alias("na"))
    shared = stage(named.join(first, ["t", "code"]), "buckets")
    # The sizes alone tell that some pairs are not similar.
    close = 100 * F.least("n", "na") >= percent * F.greatest("n", "na")
    pairs = shared.where(close & (F.col("a") != F.col("cls"))).select("a", F.col("cls").alias("b")).distinct()
    pairs = stage(pairs, "pairs")

    wanted = shared.select("cls").distinct()
    wanted = classes.join(wanted, "cls").select("cls", "__did", "__row")
    # Repeated rows would give a set several times.
    sets = _sets(known.join(wanted, ["__did", "__row"]), size).groupBy("cls").agg(F.first("members").alias("members"))
    sets = stage(sets, "sets")
    links = stage(_star_links(pairs, sets, percent), "star-links")
    once = stage(components(links), "star-components")

    placed = shared.join(once.withColumnRenamed("node", "cls"), "cls", "left")
    placed = placed.withColumn("component", F.coalesce("component", "cls"))
    open_buckets = placed.groupBy("t", "code").agg(
        F.count("*").alias("size"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.bit_xor(F.xxhash64("cls")).alias("who"),
    )
    # Buckets of several bands with the same classes are compared once.
    open_buckets = open_buckets.where("low < high").groupBy("size", "who").agg(F.min(F.struct("t", "code")).alias("bucket"))
    open_buckets = open_buckets.select("bucket.*", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    members = shared.select("t", "code", "cls").join(open_buckets, ["t", "code"])
    members = members.withColumn("block", F.pmod(F.xxhash64("cls", "t"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    more = _block_links(members.join(sets, "cls"), percent)
    joined = components(stage(links.union(more), "links"))

    per_class = classes.select("k1", "k2", "cls").join(joined.withColumnRenamed("node", "cls"), "cls", "left")
    per_class = per_class.select("k1", "k2", F.coalesce("component", "cls").alias("component"))
    owned = stage(rows.select("__did", "__row", "n", "k1", "k2").join(per_class, ["k1", "k2"]), "members")
    # Written, so that the join's sides are plain exchanges and a very large component is dealt to several tasks.
    smallest = stage(owned.groupBy("component").agg(F.min(F.struct("__did", "__row")).alias("least")), "smallest")
    found = owned.join(smallest, "component").select("__did", "__row", "n", F.col("least.__did").alias("least"), F.col("least.__row").alias("__first"))
    empty = rows.where("k1 IS NULL").select("__did", "__row", "n", F.col("__did").alias("least"), F.col("__row").alias("__first"))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).cast("long")
    return found.union(empty).select(
        real("__did").alias(id_col),
        F.col("n").alias("n_shingles"),
        real("least").alias("component_id"),
        (F.col("__did") == F.col("least")).alias("kept"),
        F.col("__row").alias("row_hash"),
        ((F.col("__did") == F.col("least")) & (F.col("__row") == F.col("__first"))).alias("first"),
    )


def keep_first(
    docs: DataFrame, percent: int = 85, size: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The first row of each component of :func:`near_duplicates`, unchanged. Rows that agree in id and text are one document: all stay."""
    kept = near_duplicates(docs, percent, size, id_col, text_col).where("first").select(id_col, "row_hash").distinct()
    return matching(docs, kept, id_col, text_col)
