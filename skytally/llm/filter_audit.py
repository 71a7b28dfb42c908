"""What each of several filters does to a corpus in every order they can be applied in.

A document's failures are a mask of bits. For a mask and an order of the filters each step has fixed outcomes, so every
kind of document (mask and marks) is mapped to one big integer whose fields hold its outcomes at all steps of all orders.
Adding the integers of all documents of a part adds all fields at once; a field has 64 bits, which no count of rows fills.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.rows import binary
from skytally.session import stage

#: Bits of a field. Sums stay below 2 to the 63rd: rows of a table times the number of orders.
FIELD_BITS = 64
#: Outcomes of a document at a step.
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: First bytes of the code points of UTF-8.
STARTS = bytes(range(0x00, 0x80)) + bytes(range(0xC0, 0x100))
SYMBOLS = re.compile(rb"[#$%&*|]")

# Failure conditions on one text -----------------------------------------------


def too_short(text: bytes, words: list[bytes]) -> bool:
    """Fewer than 50 words."""
    return len(words) < 50


def repetitive(text: bytes, words: list[bytes]) -> bool:
    """Fewer distinct words than 65 % of the words."""
    return 100 * len(set(words)) < 65 * len(words)


def shouting(text: bytes, words: list[bytes]) -> bool:
    """More than 5 % of the code points are A to Z."""
    code_points = len(text) - len(text.translate(None, STARTS))
    return 100 * (len(text) - len(text.translate(None, CAPITALS))) > 5 * code_points


def symbols(text: bytes, words: list[bytes]) -> bool:
    return SYMBOLS.search(text) is not None


CONDITIONS: tuple[Callable[[bytes, list[bytes]], bool], ...] = (too_short, repetitive, shouting, symbols)
#: Letters of the conditions above, in their order, and of the removal of copies.
NAMES = "ABCDE"


def text_failures(
    docs: DataFrame, conditions: Sequence[Callable] = CONDITIONS, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """``did``, ``part``, ``mask`` (bit i: condition i fails) and 128 bits of the text, ``h1`` and ``h2``; a row for each row.

    Conditions get the text as UTF-8 (NULL is empty) and its words, cut at ASCII white space. A NULL part is empty.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("did"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, hashes = [], []
            for text in binary(batch.column(2)):
                words = text.split()
                masks.append(sum(fails(text, words) << i for i, fails in enumerate(conditions)))
                hashes.append(xxhash.xxh3_128_digest(text))
            halves = np.frombuffer(b"".join(hashes), dtype=np.int64).reshape(-1, 2)
            columns = [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, ["did", "part", "mask", "h1", "h2"])

    return rows.mapInArrow(run, "did long, part string, mask int, h1 long, h2 long")


def with_copies(failed: DataFrame, bit: int) -> DataFrame:
    """Groups of equal rows of :func:`text_failures` with their number ``n``, the mask including ``bit`` for copies.

    A document fails if a smaller id holds the same text, anywhere in the table. Rows without an id have no smaller one
    and are smaller than none; rows that repeat an id and text are equal, none is a copy of the other. The join meets
    the first holder by text and id, so that a text that very many documents hold does not meet in one task.
    """
    rows = stage(failed.groupBy(*failed.columns).agg(F.count("*").alias("n")), "failures")
    first = rows.where("did IS NOT NULL").groupBy("h1", "h2").agg(F.min("did").alias("did")).withColumn("first", F.lit(True))
    marked = rows.join(first, ["h1", "h2", "did"], "left")
    copy = F.col("did").isNotNull() & F.col("first").isNull()
    return marked.select("did", "part", F.col("mask").bitwiseOR(F.when(copy, 1 << bit).otherwise(0)).alias("mask"), "n")


def with_marks(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds ``good`` and ``toxic``: some label of the id says quality or toxic = 1. Ids without a label are neither."""
    labelled = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("did"))
    marks = labelled.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    some = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return failed.join(marks, "did", "left").select("part", "mask", some("good"), some("toxic"), "n")


# Packed counters ----------------------------------------------------------------


def steps(names: str) -> list[tuple[str, int]]:
    """All orders of the filters with the numbers of their steps, as the fields go."""
    return [("".join(order), step) for order in permutations(names) for step in range(1, len(names) + 1)]


def packed(names: str, mask: int, good: bool, toxic: bool) -> int:
    """The integer of one document: for every step a field for each outcome, then one for each filter's removals."""
    fields: list[int] = []
    removals = dict.fromkeys(names, 0)
    fails = {name: mask >> i & 1 for i, name in enumerate(names)}
    for order, step in steps(names):
        own, before = order[step - 1], any(fails[x] for x in order[: step - 1])
        removed = fails[own] and not before
        removals[own] += removed
        only = fails[own] and sum(fails.values()) == 1
        outcomes = (not before and not fails[own], removed, fails[own] and before, only, removed and good, removed and toxic)
        fields += map(int, outcomes)
    fields += removals.values()
    return int.from_bytes(np.array(fields, dtype="<u8").tobytes(), "little")


def unpacked(names: str, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Outcomes by step, and the removals of each filter over all orders."""
    n = len(steps(names))
    size = (n * len(OUTCOMES) + len(names)) * FIELD_BITS // 8
    fields = np.frombuffer(total.to_bytes(size, "little"), dtype="<u8").astype(np.int64)
    return fields[: n * len(OUTCOMES)].reshape(n, -1), fields[n * len(OUTCOMES) :]


def audit(failed: DataFrame, names: str = NAMES) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    ``failed`` has ``part``, ``mask`` (bit i: the i-th filter of ``names`` fails), ``good``, ``toxic`` and ``n``, the
    number of documents of the kind. Documents of a kind are counted before they meet, so a part gets at most
    2 to the power of (filters + 2) rows however many documents it has. No documents, no rows.

    Columns: ``filter_order``, ``step``; ``kept`` after the step; ``removed`` by it; ``redundant``, failing its filter but
    removed earlier; ``unique_fails``, failing this filter only; ``good_lost`` and ``toxic_lost``, the removed that are
    marked so; ``shapley``, what the step's filter removes, summed over all orders.
    """
    kinds = failed.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    parts = kinds.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("kinds"))
    places = steps(names)
    orders, numbers = pa.array([o for o, _ in places]), pa.array([s for _, s in places], pa.int32())
    own = np.array([names.index(order[step - 1]) for order, step in places])
    schema = T.StructType().add("part", "string").add("filter_order", "string").add("step", "integer")
    for name in (*OUTCOMES, "shapley"):
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        integers: dict[tuple, int] = {}
        for batch in batches:
            for part, own_kinds in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total = 0
                for kind in own_kinds:
                    key = kind["mask"], kind["good"], kind["toxic"]
                    if key not in integers:
                        integers[key] = packed(names, *key)
                    total += kind["n"] * integers[key]
                outcomes, removals = unpacked(names, total)
                columns = [pa.array([part] * len(places)), orders, numbers, *map(pa.array, outcomes.T.copy()), pa.array(removals[own])]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return parts.mapInArrow(run, schema)


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the four text conditions and the removal of copies (letters A to E) for each source.

    NULL and empty texts are too short and are copies of each other; a NULL source is the empty one.
    """
    return audit(with_marks(with_copies(text_failures(docs), len(CONDITIONS)), labels))
