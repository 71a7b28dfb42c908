"""Removal of lines that many documents share, by probing sharded minimal perfect hash arrays.

1. Every task counts the distinct line keys of its documents (128-bit hashes) before the counts are shuffled.
2. The hashes of shared lines are dealt into shards. A minimal perfect hash of each shard, a few bit levels, gives
   every hash its own slot in two compact arrays: the fingerprint that tells other hashes apart, and what is known of
   the line (documents holding it, the largest id among them).
3. Documents probe the arrays: a task packs the probes of a batch of documents by shard, the shard answers with the
   lines to drop. Lines are never joined with lines. Lines in very many documents would all meet in one shard; there
   are few of them (their number is bounded), so that every task holds them itself.
4. Documents drop the lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.rows import NO_ID, binary, keyed, rewrite
from skytally.session import stage

SPACE = b" \t\n\x0b\x0c\r"
#: Distinct keys a task counts before it hands them on.
HELD = 200_000
#: Slots for each hash in a level of the minimal perfect hash.
LOAD = 1.5
KEYS_PER_SHARD = 8192
#: A key found in so many documents, and in this share of all found, is known to every task: 20,000 keys at most.
HOT_DOCS = 1000
HOT_KEYS = 20_000


def line_keys(text: bytes) -> list[bytes]:
    """Each line stripped of white space at both ends, A to Z in lower case."""
    return [line.strip(SPACE).lower() for line in text.split(b"\n")]


def _digests(text: bytes, min_chars: int) -> list[bytes | None]:
    """128-bit hash of each line's key; None for keys with fewer code points than ``min_chars``."""
    out: list[bytes | None] = []
    for key in line_keys(text):
        long = len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars)
        out.append(xxhash.xxh3_128_digest(key) if long else None)
    return out


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _slot_hash(low: np.ndarray, level: int) -> np.ndarray:
    x = low + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def build_hash(low: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Minimal perfect hash of distinct 64-bit values: the size of each level, and all levels' bits.

    A level sets the bits that exactly one of the remaining values falls on; the others go on to the next.
    """
    sizes: list[int] = []
    levels: list[np.ndarray] = []
    rest = low
    while len(rest):
        size = max(8, int(LOAD * len(rest)))
        at = (_slot_hash(rest, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        levels.append(alone)
        rest = rest[~alone[at]]
    return sizes, np.concatenate(levels) if levels else np.zeros(0, dtype=bool)


def slots(low: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each value, -1 where no level has its bit. Other values than those built from may get any slot."""
    rank = np.cumsum(bits) - 1
    out = np.full(len(low), -1, dtype=np.int64)
    left = np.arange(len(low))
    start = 0
    for level, size in enumerate(sizes):
        at = (_slot_hash(low[left], level) % np.uint64(size)).astype(np.int64) + start
        found = bits[at]
        out[left[found]] = rank[at[found]]
        left = left[~found]
        start += size
    return out


def shared_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``hi``, ``lo`` (hash of a key), ``n`` (rows with the key) and the row to keep it, of keys in ``min_docs`` rows or more.

    That is the row with the largest id, ``top``, if ``real``; else no row with the key has an id, and ``top`` is the
    largest hash of a row.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}

        def out() -> pa.RecordBatch:
            hi, lo = _halves(list(held))
            n, real, top = np.array([(n, *holder) for n, holder in held.values()], dtype=np.int64).reshape(-1, 3).T
            arrays = [pa.array(x) for x in (hi.view(np.int64), lo.view(np.int64), n, real, top)]
            return pa.RecordBatch.from_arrays(arrays, ["hi", "lo", "n", "real", "top"])

        for batch in batches:
            for did, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), binary(batch.column(2)), strict=True):
                holder = (0, row) if did == NO_ID else (1, did)
                for digest in set(_digests(text, min_chars)):
                    if digest is not None:
                        entry = held.setdefault(digest, [0, holder])
                        entry[0] += 1
                        if holder > entry[1]:
                            entry[1] = holder
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    counts = docs.select("__did", "__row", "__text").mapInArrow(count, "hi long, lo long, n long, real long, top long")
    summed = counts.groupBy("hi", "lo").agg(F.sum("n").alias("n"), F.max(F.struct("real", "top")).alias("holder"))
    return summed.where(F.col("n") >= min_docs).select("hi", "lo", "n", "holder.real", "holder.top")


def build_index(lines: DataFrame, n_shards: int) -> DataFrame:
    """One row per shard: ``sizes`` and ``bits`` of the hash, and the arrays ``prints``, ``counts``, ``reals``, ``tops`` as bytes."""

    def build(table: pa.Table) -> pa.Table:
        shard, hi, lo, n, real, top = (table.column(c).to_numpy() for c in ("shard", "hi", "lo", "n", "real", "top"))
        low = lo.astype(np.int64).view(np.uint64)
        sizes, bits = build_hash(low)
        order = np.argsort(slots(low, sizes, bits))
        counts = np.minimum(n[order], (1 << 32) - 1).astype("<u4")  # a count beyond that reads as that
        holders = [real[order].astype("u1"), top[order].astype("<i8")]
        arrays = [np.array(sizes, "<i8"), np.packbits(bits), hi[order].astype("<i8"), counts, *holders]
        return pa.table(
            {"shard": pa.array(shard[:1], pa.int64())}
            | {k: pa.array([a.tobytes()], pa.binary()) for k, a in zip(INDEX, arrays, strict=True)}
        )

    dealt = lines.select(F.pmod("hi", F.lit(n_shards)).cast("long").alias("shard"), "hi", "lo", "n", "real", "top")
    schema = "shard long, " + ", ".join(f"{c} binary" for c in INDEX)
    return dealt.groupBy("shard").applyInArrow(build, schema)


INDEX = ("sizes", "bits", "prints", "counts", "reals", "tops")


def _probes(docs: DataFrame, n_shards: int, min_chars: int, hot: dict[bytes, int]) -> DataFrame:
    """Packed probes: for each batch of documents and shard one row with the ids, row hashes and line hashes as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, of = [], []
            for i, text in enumerate(binary(batch.column(2))):
                own = [d for d in set(_digests(text, min_chars)) if d is not None and d not in hot]
                digests += own
                of += [i] * len(own)
            if not digests:
                continue
            hi, lo = _halves(digests)
            did, row = (batch.column(c).to_numpy()[of] for c in (0, 1))
            shard = np.mod(hi.view(np.int64), n_shards)
            order = np.argsort(shard, kind="stable")
            which, start = np.unique(shard[order], return_index=True)
            parts = [np.split(a[order], start[1:]) for a in (did, row, hi, lo)]
            packed = [pa.array([x.tobytes() for x in p], pa.binary()) for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(which, pa.int64()), *packed], ["shard", "did", "row", "hi", "lo"])

    return docs.select("__did", "__row", "__text").mapInArrow(
        pack, "shard long, did binary, row binary, hi binary, lo binary"
    )


def _answers(index: DataFrame, probes: DataFrame, min_docs: int) -> DataFrame:
    """``__did``, ``__row``, ``lo`` of every line to drop. A task reads a shard's arrays, then the probes of the shard."""
    none = F.lit(None).cast("binary")
    both = index.select("shard", F.lit(0).alias("kind"), *INDEX, *[none.alias(c) for c in ("did", "row", "hi", "lo")]).union(
        probes.select("shard", F.lit(1).alias("kind"), *[none.alias(c) for c in INDEX], "did", "row", "hi", "lo")
    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = None
        for batch in batches:
            found = []
            for x in batch.to_pylist():
                if x["kind"] == 0:
                    sizes = np.frombuffer(x["sizes"], "<i8").tolist()
                    bits = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=sum(sizes)).astype(bool)
                    arrays = [np.frombuffer(x[c], t) for c, t in (("prints", "<i8"), ("counts", "<u4"), ("reals", "u1"), ("tops", "<i8"))]
                    have = (x["shard"], sizes, bits, *arrays)
                elif have and have[0] == x["shard"]:  # else no shared line is in this shard
                    _, sizes, bits, prints, counts, reals, tops = have
                    did, row, hi, lo = (np.frombuffer(x[c], "<i8") for c in ("did", "row", "hi", "lo"))
                    slot = slots(lo.view(np.uint64), sizes, bits)
                    known = (slot >= 0) & (prints[slot] == hi)
                    keeps = np.where(reals[slot] == 1, tops[slot] == did, tops[slot] == row)
                    drop = known & (counts[slot] >= min_docs) & ~keeps
                    found.append((did[drop], row[drop], lo[drop]))
            if found:
                columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["__did", "__row", "lo"])

    near = both.repartition("shard").sortWithinPartitions("shard", "kind")
    return near.mapInArrow(answer, "__did long, __row long, lo long")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """``docs`` without the lines that ``min_docs`` rows or more share, but for the row with the largest id holding it.

    Lines end at ``\\n``; a line's key is the line stripped of ASCII white space, A-Z in lower case. Keys of fewer than
    ``min_chars`` code points stay. Adds ``n_lines`` (before) and ``n_dropped``; columns with these names are replaced.
    A NULL or empty text is one empty line, and the result's text is empty, not NULL. Every row counts as a document;
    repeated rows are treated alike. Rows with an id go before those without one; of a line that only rows without an id
    hold, that with the largest row hash keeps it, so no line is lost altogether. An empty table gives an empty table.
    Lines are told apart by 128-bit hashes.
    """
    spark = docs.sparkSession
    known = keyed(docs, id_col, text_col)
    texts = known.select("__did", "__row", F.col(text_col).alias("__text"))
    lines = stage(shared_lines(texts, min_chars, min_docs), "shared-lines")
    n_keys, found = lines.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_keys // KEYS_PER_SHARD))
    # All counts sum up to ``found``, so no more than HOT_KEYS keys can hold such a share of it.
    few = lines.where((F.col("n") >= HOT_DOCS) & (F.col("n") >= F.lit(found // HOT_KEYS + 1))).select("hi", "lo", "real", "top")
    hot = {np.array([r.hi, r.lo], "<i8").tobytes(): (r.real, r.top) for r in few.collect()}
    index = build_index(lines, n_shards)
    dropped = _answers(index, _probes(texts, n_shards, min_chars, hot), min_docs)
    dropped = dropped.groupBy("__did", "__row").agg(F.collect_set("lo").alias("__lines"))

    def drop(values: dict[str, list], texts: list[bytes]) -> tuple[list[bytes], list[list]]:
        out, n_lines, n_dropped = [], [], []
        for did, row, listed, text in zip(values["__did"], values["__row"], values["__lines"], texts, strict=True):
            lines = text.split(b"\n")
            n_lines.append(len(lines))
            if listed or hot:
                gone = set(listed or ())
                digests = _digests(text, min_chars)
                keep = [
                    d is None or (hot[d] in ((1, did), (0, row)) if d in hot else int.from_bytes(d[8:], "little", signed=True) not in gone)
                    for d in digests
                ]
                lines = [line for line, k in zip(lines, keep, strict=True) if k]
            n_dropped.append(n_lines[-1] - len(lines))
            out.append(b"\n".join(lines))
        return out, [n_lines, n_dropped]

    joined = known.join(dropped, ["__did", "__row"], "left")
    return rewrite(joined, text_col, {"n_lines": "long", "n_dropped": "long"}, ["__did", "__row", "__lines"], drop).select(
        *[c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")], "n_lines", "n_dropped"
    )
