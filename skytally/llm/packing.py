"""Packing of tokenised documents into windows of near-equal length by Karmarkar-Karp differencing.

A document is cut into full windows, which are sequences of their own, and a rest. Rests are dealt into groups of
about equally many tokens, and each group is packed by itself: every piece starts as a partial partition of one
piece, the two partial partitions with the largest imbalance are merged, the longest window of one with the shortest
of the other, until one partition is left. If its longest window exceeds the capacity, the number of windows rises.
"""

from __future__ import annotations


import bisect
import heapq
import json
import re
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.rows import binary
from skytally.session import stage

# Fixed value: how byte-level BPE of this kind splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longest piece of a rest: a piece longer than a quarter of the window would leave gaps that no other piece fills.
PIECE_SHARE = 4
#: Tokens a group has on average; it is packed in one task.
GROUP_TOKENS = 1 << 20


def byte_ranks(tokenizer: str) -> dict[bytes, int]:
    """Ids by token of a byte-level BPE vocabulary (a file of the ``tokenizers`` library).

    The ids must be in the order of the merges, as in the public vocabularies of this kind: then they are the ranks
    that ``tiktoken`` works with, and its ids are those of ``tokenizers``, in a fifth of the time.
    """
    content = json.loads(Path(tokenizer).read_text(encoding="utf-8"))
    model = content["model"]
    plain = model["type"] == "BPE" and not (model.get("dropout") or model.get("ignore_merges") or content.get("normalizer"))
    before = content["pre_tokenizer"] or {}
    if not plain or (before.get("type"), before.get("add_prefix_space"), before.get("use_regex")) != ("ByteLevel", False, True):
        raise ValueError(f"{tokenizer} is no plain byte-level BPE vocabulary")
    # The characters that stand for bytes. Printable ones stand for themselves, the rest follow from 256 on.
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in own]
    byte_of = {chr(x): x for x in own} | {chr(256 + i): x for i, x in enumerate(rest)}
    special = {token["content"] for token in content["added_tokens"]}
    ids = {t: i for t, i in model["vocab"].items() if t not in special}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    order = [ids[m] for m in merged]
    if order != sorted(order) or len(ids) != len(merged) + 256:
        raise ValueError(f"the ids of {tokenizer} are not in the order of its merges")
    return {bytes(byte_of[c] for c in token): i for token, i in ids.items()}


def added_tokens(tokenizer: str) -> dict[str, int]:
    """Ids of the strings that the library finds in a text before it splits it."""
    added = json.loads(Path(tokenizer).read_text(encoding="utf-8"))["added_tokens"]
    if any(token.get(flag) for token in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{tokenizer} has added tokens that depend on the text around them")
    return {token["content"]: token["id"] for token in added}


def encoder(ranks: dict[bytes, int], added: dict[str, int] | None = None) -> Callable[[str], list[int]]:
    """Ids of a text; the strings of ``added`` have ids of their own, the leftmost and longest first."""
    import tiktoken

    ordinary = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    if not added:
        return ordinary
    whole = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")")

    def encode(text: str) -> list[int]:
        parts = whole.split(text)
        if len(parts) == 1:
            return ordinary(text)
        # Every other part is an added token.
        return [x for i, part in enumerate(parts) for x in ([added[part]] if i % 2 else ordinary(part))]

    return encode


def pieces(
    docs: DataFrame, tokenizer: str, end: int, window: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` and ``row`` (tells repeated rows apart) of every piece."""
    longest = max(1, window // PIECE_SHARE)
    ranks = docs.sparkSession.sparkContext.broadcast((byte_ranks(tokenizer), added_tokens(tokenizer)))  # as large as the vocabulary

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*ranks.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                rows: list[tuple] = []
                texts = binary(some.column(2))
                for doc, row, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), texts, strict=True):
                    ids = np.array([*encode(text.decode("utf-8")), end], dtype="<u4")
                    n = len(ids)
                    full = n // window * window
                    rest = n - full
                    parts = -(-rest // longest)
                    cuts = [*range(0, full, window), *(full + rest * k // parts for k in range(parts)), n]
                    rows += [(doc, a, b - a, zlib.crc32(ids[a:b]), n, row) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], NAMES)

    schema = ", ".join(f"{c} long" for c in NAMES)
    numbered = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text")
    )
    return numbered.mapInArrow(cut, schema)


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row"]


def differencing(sizes: list[int], n: int) -> list[int]:
    """Window (0 to ``n`` - 1) of each piece, by multiway differencing.

    A partial partition is its non-empty windows (length, number, pieces), shortest first; those not listed are empty.
    """
    heap = [(-size, i, [(size, i, [i])]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        if len(a) < len(b):
            a, b = b, a
        # The longest windows of one meet the shortest of the other, empty ones first.
        empty = min(n - len(a), len(b))
        shortest = a[: len(b) - empty]
        del a[: len(b) - empty]
        b.reverse()
        for window in b[:empty]:
            bisect.insort(a, window)
        for (size, k, members), (more, _, others) in zip(shortest, b[empty:], strict=True):
            members.extend(others)
            bisect.insort(a, (size + more, k, members))
        spread = a[-1][0] - (a[0][0] if len(a) == n else 0)
        heapq.heappush(heap, (-spread, i, a))
    out = [0] * len(sizes)
    for window, (_, _, members) in enumerate(heap[0][2] if heap else []):
        for i in members:
            out[i] = window
    return out


def pack_group(sizes: list[int], capacity: int) -> list[int]:
    """Window of each piece: the fewest windows that hold all, raised while differencing exceeds the capacity."""
    n = -(-sum(sizes) // capacity)
    while True:
        windows = differencing(sizes, n)
        longest = int(np.bincount(windows, weights=sizes, minlength=1).max()) if sizes else 0
        if longest <= capacity:
            return windows
        n += max(1, (n * longest // capacity - n) // 2)


def pack(
    docs: DataFrame, tokenizer: str, end: int = 1, window: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A document is the ids of its text and then the id ``end``; a NULL or empty text is the id ``end`` alone. Every
    row is a document of its own, also a repeated one or one without an id. Pieces of a sequence lie side by side from
    offset 0, in the order of id, row and start. An empty table gives an empty table. ``tokenizer`` is the path of a
    vocabulary file of the ``tokenizers`` library; its added tokens have their ids in a text too, as in the library.
    """
    cut = stage(pieces(docs, tokenizer, end, window, id_col, text_col), "pieces")
    rests = cut.where(F.col("length") < window)
    tokens = rests.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    groups = max(1, -(-tokens // GROUP_TOKENS))

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([("row", "ascending"), ("start", "ascending")])
        sizes = table.column("length").to_pylist()
        windows = np.array(pack_group(sizes, window), dtype=np.int64)
        lengths = np.array(sizes, dtype=np.int64)
        order = np.argsort(windows, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.searchsorted(windows[order], windows[order])
        offset = np.empty_like(before)
        offset[order] = before - before[first]
        out = table.append_column("window", pa.array(windows)).append_column("offset", pa.array(offset))
        return out.select([*NAMES, "group", "window", "offset"])

    dealt = rests.withColumn("group", F.pmod(F.xxhash64("row", "start"), F.lit(groups)))
    packed = dealt.groupBy("group").applyInArrow(
        fill, ", ".join(f"{c} long" for c in [*NAMES, "group", "window", "offset"])
    )
    # Rests take the even numbers, by group and window; full pieces the odd ones, by row and place.
    shift = 1 << 24
    short = packed.withColumn("sequence_id", 2 * (F.col("group") * shift + F.col("window")))
    full = cut.where(F.col("length") == window)
    numbered = full.withColumns({"sequence_id": 2 * F.monotonically_increasing_id() + 1, "offset": F.lit(0).cast("long")})
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return short.select(*columns).unionByName(numbered.select(*columns))
