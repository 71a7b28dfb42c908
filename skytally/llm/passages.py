"""What the two ways to remove repeated passages share: candidate windows, copies of whole texts, cutting words out.

A window is ``WINDOW`` consecutive words. Its anchor is the position, among its first ``REACH`` ones, where the next
``PREFIX`` words have the least hash: equal windows have their anchors at the same place. So a window can only repeat
in another text if the words at its anchor do. Anchors are about one in sixteen positions; finding those whose words
repeat leaves a small part of all windows to look at closely.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.rows import NO_ID, binary, rewrite
from skytally.llm.words import mix, run_hashes, word_hashes

WINDOW = 50
#: A power of two.
REACH = 32
PREFIX = WINDOW - REACH + 1
#: Anchors, and texts, a task remembers to tell at once what repeats within it.
HELD = 400_000
#: Texts whose words are numbered together.
TOGETHER = 64

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of the window at each position, and the hash of the ``PREFIX`` words at each position."""
    prefixes = run_hashes(words, PREFIX)
    if len(words) < WINDOW:
        return np.zeros(0, dtype=np.int64), prefixes
    order = mix(prefixes)
    at, step = np.arange(len(prefixes)), 1
    while step < REACH:
        left, right = at[:-step], at[step:]
        at = np.where(order[left] <= order[right], left, right)
        step *= 2
    return at, prefixes


def anchors_of(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions in ``words``, those of several texts, of windows that lie within a text, and their anchors; the hash of the
    ``PREFIX`` words at each position, and the number of the text it lies in."""
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    anchor, prefixes = anchors(words)
    at = np.flatnonzero(text[: len(anchor)] == text[WINDOW - 1 :])
    return at, anchor[at], prefixes, text


def with_hashes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Adds ``__did``, the id to order by (NULL is largest), and ``__h1``, ``__h2``, hashes of the text."""
    return docs.withColumns(
        {
            "__did": F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)),
            "__h1": F.xxhash64(text_col),
            "__h2": F.xxhash64(F.lit(1), text_col),
        }
    )


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """``__h1`` and ``at``, the anchors of a text whose prefix also is at an anchor of another text.

    Suffixes at anchors are sorted by the hash of their prefix, and neighbours from different texts mark each other.
    A task hands on two texts of a prefix at most; further ones it knows to repeat, and they need not meet the others.
    So a passage that very many texts hold doesn't gather in one task.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        first: dict[int, int | None] = {}
        for batch in batches:
            known: list[bool] = []
            parts: list[tuple[np.ndarray, ...]] = []
            for i in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(i, TOGETHER)
                new = {h1: text for h1, text in zip(some.column(0).to_pylist(), binary(some.column(1)), strict=True) if h1 not in seen}
                seen.update(new)
                words, starts = word_hashes(list(new.values()))
                _, at, prefixes, text_of = anchors_of(words, starts)
                at = at[np.diff(at, prepend=-1) != 0]  # anchors are in order
                keys, of = prefixes[at].view(np.int64), np.array(list(new), dtype=np.int64)[text_of[at]]
                for key, h1 in zip(keys.tolist(), of.tolist(), strict=True):
                    held = first.setdefault(key, h1)
                    known.append(held is None)
                    if held is not None and held != h1:
                        first[key] = None
                parts.append((keys, of, (at - starts[text_of[at]]).astype(np.int32)))
            if len(seen) > HELD:
                seen.clear()
            if len(first) > HELD:
                first.clear()
            if known:
                key, h1, place_of = (pa.array(np.concatenate(x)) for x in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(known), key, h1, place_of], names)

    names = ["known", "key", "__h1", "at"]
    found = docs.select("__h1", "__text").mapInArrow(scan, "known boolean, key long, __h1 long, at int")
    place = F.when(F.col("known"), F.col("__h1")).otherwise(F.col("key"))
    ordered = found.repartition(place).sortWithinPartitions("known", "key", "__h1", "at")

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            known, key, h1, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            sure = known.astype(bool)
            out_h1, out_at = [h1[sure]], [at[sure]]
            rest = [x[~sure] for x in (key, h1, at)]
            if held is not None:
                rest = [np.concatenate(x) for x in zip(held, rest, strict=True)]
            held = None
            if len(rest[0]):
                starts = np.flatnonzero(np.r_[True, rest[0][1:] != rest[0][:-1]])
                last = starts[-1]  # its run may go on in the next batch
                repeated = rest[1][starts[:-1]] != rest[1][starts[1:] - 1]  # texts are in order within a run
                use = np.repeat(repeated, np.diff(starts))
                out_h1.append(rest[1][:last][use])
                out_at.append(rest[2][:last][use])
                held = [x[last:] for x in rest]
            arrays = [pa.array(np.concatenate(out_h1)), pa.array(np.concatenate(out_at))]
            yield pa.RecordBatch.from_arrays(arrays, ["__h1", "at"])
        if held is not None and len(held[0]) and held[1][0] != held[1][-1]:
            yield pa.RecordBatch.from_arrays([pa.array(held[1]), pa.array(held[2])], ["__h1", "at"])

    return ordered.mapInArrow(neighbours, "__h1 long, at int")


def candidates(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The first document of each text that has repeated anchors, with all columns of ``docs`` and ``__at``."""
    found = repeated_anchors(docs).groupBy("__h1").agg(F.collect_set("at").alias("__at"))
    wanted = classes.join(found, "__h1").select(F.col("first").alias("__did"), "__h1", "__at")
    return docs.join(wanted, ["__did", "__h1"])


def text_classes(docs: DataFrame) -> DataFrame:
    """``__h1``, ``__h2`` and ``first``, the smallest id, of every different text."""
    return docs.groupBy("__h1", "__h2").agg(F.min("__did").alias("first"))


def later_copies(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``__did``, ``__h1`` of documents whose whole text is that of a document with a smaller id."""
    rows = docs.select("__did", "__h1", "__h2").join(classes, ["__h1", "__h2"])
    return rows.where("first < __did").select("__did", "__h1").distinct()


def window_rows(docs: DataFrame, columns: list[str]) -> DataFrame:
    """One row for each window of ``docs`` whose anchor is in ``__at``: ``__did``, ``__h1`` and of the others those named.

    ``p``: position of its first word; ``edge``: hash of its words; ``before``, ``after``: of the windows one word
    earlier and later, NULL at the ends of the text.
    """
    kinds = {"p": "int", "edge": "long", "before": "long", "after": "long"}
    names = ["__did", "__h1", *columns]
    place = {c: docs.columns.index(c) for c in ("__did", "__h1", "__at", "__text")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(i, TOGETHER)
                dids, h1s, marked = (batch.column(place[c]).to_pylist() for c in ("__did", "__h1", "__at"))
                parts: list[list[pa.Array]] = []
                for did, h1, at, text in zip(dids, h1s, marked, binary(batch.column(place["__text"])), strict=True):
                    words, _ = word_hashes([text])
                    anchor, _ = anchors(words)
                    edges = run_hashes(words, WINDOW).view(np.int64)
                    chosen = np.zeros(len(words) + 1, dtype=bool)
                    chosen[at] = True
                    p = np.flatnonzero(chosen[anchor])
                    values = {"p": pa.array(p.astype(np.int32)), "edge": pa.array(edges[p])}
                    if "before" in columns:
                        values["before"] = pa.array(edges[np.maximum(p - 1, 0)], mask=p == 0)
                        values["after"] = pa.array(edges[np.minimum(p + 1, len(edges) - 1)], mask=p == len(edges) - 1)
                    own = [pa.array(np.full(len(p), x, dtype=np.int64)) for x in (did, h1)]
                    parts.append([*own, *(values[c] for c in columns)])
                if parts:
                    yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*parts, strict=True)], names)

    return docs.mapInArrow(run, ", ".join(["__did long", "__h1 long", *(f"{c} {kinds[c]}" for c in columns)]))


def cut_words(docs: DataFrame, spans: DataFrame, copies: DataFrame) -> DataFrame:
    """``docs`` without the words that ``spans`` cover (``__did``, ``__h1``, ``__spans``: first word and length of each).

    A span with a third value, ``sum``, counts only if it is the bitwise sum of the hashes of the windows in the span.
    Documents of ``copies`` lose all their words if they have a window. Adds ``n_words`` (before) and ``n_removed``.
    What is left keeps its white space; stretches that weren't neighbours before are joined by one space.
    """
    none = F.lit(None).cast(spans.schema["__spans"].dataType)
    whole = copies.select("__did", "__h1", none.alias("__spans"), F.lit(True).alias("__whole"))
    marks = spans.select("__did", "__h1", "__spans", F.lit(False).alias("__whole")).unionByName(whole)

    checked = len(spans.schema["__spans"].dataType.elementType.fields) == 3

    def cut(values: dict[str, list], texts: list[bytes]) -> tuple[list[bytes], list[list]]:
        out, n_words, n_removed = [], [], []
        for listed, all_words, text in zip(values["__spans"], values["__whole"], texts, strict=True):
            n = len(text.split())
            gone = 0
            if all_words and n >= WINDOW:
                text, gone = b"", n
            elif listed:
                change = np.zeros(n + 1, dtype=np.int64)
                pairs = np.array([tuple(s.values()) for s in listed], dtype=np.int64)
                if checked:
                    edges = run_hashes(word_hashes([text])[0], WINDOW).view(np.int64)
                    sums = np.bitwise_xor.accumulate(np.r_[np.int64(0), edges])
                    ends = np.minimum(pairs[:, 0] + pairs[:, 1] - WINDOW + 1, len(edges))
                    pairs = pairs[sums[ends] ^ sums[pairs[:, 0]] == pairs[:, 2]][:, :2]
                np.add.at(change, pairs[:, 0], 1)
                np.add.at(change, pairs.sum(axis=1), -1)
                kept = np.cumsum(change[:-1]) == 0
                gone = n - int(kept.sum())
                ends = [m.span() for m in WORD.finditer(text)]
                edges = np.flatnonzero(np.diff(np.r_[False, kept, False]))
                text = b" ".join(text[ends[a][0] : ends[b - 1][1]] for a, b in edges.reshape(-1, 2).tolist())
            out.append(text)
            n_words.append(n)
            n_removed.append(gone)
        return out, [n_words, n_removed]

    joined = docs.join(marks, ["__did", "__h1"], "left")
    fields = {"n_words": "long", "n_removed": "long"}
    return rewrite(joined, "__text", fields, ["__did", "__h1", "__h2", "__spans", "__whole"], cut)


def remove(docs: DataFrame, id_col: str, text_col: str, find) -> DataFrame:
    """Applies ``find`` (candidates to spans) to ``docs`` and cuts. The text crosses one exchange, read three times."""
    others = [c for c in docs.columns if c.lower() not in ("n_words", "n_removed")]
    known = with_hashes(docs.select(*others), id_col, text_col).withColumnRenamed(text_col, "__text")
    classes = text_classes(known)
    spans = find(candidates(known, classes))
    cut = cut_words(known, spans, later_copies(known, classes)).withColumnRenamed("__text", text_col)
    return cut.select(*others, "n_words", "n_removed")
