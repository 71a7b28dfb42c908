"""Repeated passages by sparse suffixes.

Suffixes are retained at content-selected minimiser positions only (:mod:`skytally.llm.passages`): equal windows of 50 words
have their minimisers at the same place, so a window is known by its suffix and its offset from it. Suffixes are sorted
by their first 19 words and by document, and each is compared with the neighbours before it in its run, the first ones that
hold something new: from the minimiser on, to the left and to the right, as far as windows agree at equal offsets. Tasks
do so on what they read first, so that a passage that very many documents hold leaves a task a few times at most.

A window may have a smaller holder that is none of these neighbours. What remains after the comparison, all smallest
holders among it, is therefore sorted by whole windows once more, and of a run of equal windows the one of the smallest
document id stays. A window that a smaller document holds is found in either way, since its smallest holder always remains.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.passages import TOGETHER, WINDOW, anchors_of, remove
from skytally.llm.rows import binary
from skytally.llm.words import run_hashes, word_hashes
from skytally.session import stage

#: Beginnings of suffixes a task remembers, and suffixes of each that others are compared with: before and after sorting.
HELD = 50_000
NEAR, NEAR_SORTED = 6, 32
#: Suffixes with one beginning that a task sends to meet the others; further ones are spread by their text.
MEET = 64


class _Suffix:
    """Windows of a document around one minimiser ``at``: hashes of those that start ``top``, ``top - 1``, ... words before it."""

    __slots__ = ("did", "h1", "at", "top", "edges")

    def __init__(self, did: int, h1: int, at: int, top: int, edges: np.ndarray):
        self.did, self.h1, self.at, self.top, self.edges = did, h1, at, top, edges

    def shared(self, other: _Suffix) -> np.ndarray:
        """Which of the windows the other suffix has at the same offset."""
        out = np.zeros(len(self.edges), dtype=bool)
        high = min(self.top, other.top)
        low = max(self.top - len(self.edges), other.top - len(other.edges)) + 1
        if high >= low:
            own = self.edges[self.top - high : self.top - low + 1]
            out[self.top - high : self.top - low + 1] = own == other.edges[other.top - high : other.top - low + 1]
        return out

    def runs(self, which: np.ndarray) -> Iterator[tuple[int, int]]:
        """First and last-but-one index of neighbouring windows among ``which``."""
        edges = np.flatnonzero(np.diff(np.r_[False, which, False]))
        return zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)

    def spans(self, which: np.ndarray) -> list[tuple[int, int]]:
        """First word and length of the passages that ``which`` of the windows cover."""
        return [(self.at - self.top + a, b - a + WINDOW - 1) for a, b in self.runs(which)]

    def rest(self, which: np.ndarray) -> list[_Suffix]:
        """What is left without ``which``."""
        return [_Suffix(self.did, self.h1, self.at, self.top - a, self.edges[a:b]) for a, b in self.runs(~which)]


class _Run:
    """Suffixes with one beginning that others are compared with."""

    __slots__ = ("holders",)

    def __init__(self):
        self.holders: list[_Suffix] = []

    def covered(self, suffix: _Suffix, most: int) -> np.ndarray:
        """Which windows of the suffix a smaller document among the holders has. It becomes one of at most ``most``
        holders if it has others; when there are too many, those of the smallest documents stay."""
        same = np.zeros(len(suffix.edges), dtype=bool)
        for other in self.holders:
            if other.did < suffix.did:
                same |= suffix.shared(other)
                if same.all():
                    return same
        if len(self.holders) < most:
            self.holders.append(suffix)
        else:
            last = max(range(most), key=lambda i: self.holders[i].did)
            if suffix.did < self.holders[last].did:
                self.holders[last] = suffix
        return same


def _of_texts(dids: list[int], h1s: list[int], marked: list[list[int]], texts: list[bytes]) -> Iterator[tuple[int, _Suffix]]:
    """Key (of the first 19 words) and suffix for each of the marked minimisers of some texts."""
    words, starts = word_hashes(texts)
    place, anchor, prefixes, text_of = anchors_of(words, starts)
    edges = run_hashes(words, WINDOW).view(np.int64)
    chosen = np.zeros(len(words) + 1, dtype=bool)
    chosen[np.repeat(starts[:-1], [len(m) for m in marked]) + np.array([i for m in marked for i in m], dtype=np.int64)] = True
    place, anchor = place[chosen[anchor]], anchor[chosen[anchor]]
    bounds = np.flatnonzero(np.diff(anchor, prepend=-1, append=-1))  # windows of a minimiser are neighbours
    at, first = anchor[bounds[:-1]], place[bounds[:-1]]
    of = text_of[at]
    columns = (prefixes[at].view(np.int64), of, at - starts[of], at - first, first, np.diff(bounds))
    for key, i, own, top, begin, n in zip(*(c.tolist() for c in columns), strict=True):
        yield key, _Suffix(dids[i], h1s[i], own, top, edges[begin : begin + n].copy())


SUFFIX = "key long, salt long, __did long, __h1 long, at int, top int, edges binary, p int, n int"
FOUND = "__did long, __h1 long, p int, n int, edge long"


def _columns(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(x.split() for x in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], list(names))


def suffixes(docs: DataFrame) -> DataFrame:
    """Suffixes of the candidates without the windows that a smaller document of the same task has; these as passages."""
    place = {c: docs.columns.index(c) for c in ("__did", "__h1", "__at", "__text")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[int, _Run] = {}
        sent: dict[int, int] = {}
        for whole in batches:
            for i in range(0, whole.num_rows, TOGETHER):
                batch, rows = whole.slice(i, TOGETHER), []
                columns = [batch.column(place[c]).to_pylist() for c in ("__did", "__h1", "__at")]
                for key, suffix in _of_texts(*columns, binary(batch.column(place["__text"]))):
                    did, h1 = suffix.did, suffix.h1
                    if key not in first:
                        first[key] = _Run()
                    same = first[key].covered(suffix, NEAR)
                    rows += [(None, None, did, h1, None, None, None, p, n) for p, n in suffix.spans(same)]
                    left = suffix.rest(same)
                    if left:
                        sent[key] = sent.get(key, 0) + 1
                    salt = h1 if sent.get(key, 0) > MEET else 0
                    rows += [(key, salt, did, h1, x.at, x.top, x.edges.tobytes(), None, None) for x in left]
                if len(first) > HELD:
                    first.clear()
                if len(sent) > 4 * HELD:
                    sent.clear()
                yield _columns(rows, SUFFIX)

    return docs.mapInArrow(run, SUFFIX)


def neighbours(found: DataFrame) -> DataFrame:
    """Passages that a smaller document has too (``p``, ``n``), and single windows (``p``, ``edge``) that are still to be looked at."""
    # Passages are done: they stay where they are, spread by their document.
    place = [F.coalesce("key", "__did"), F.coalesce("salt", "p")]
    ordered = found.repartition(*place).sortWithinPartitions("key", "salt", "__did", "__h1", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_of, near = None, _Run()
        for batch in batches:
            done: list[tuple] = []
            owners: list[tuple[int, int, int]] = []
            places, edges = [], []
            columns = [batch.column(i).to_pylist() for i in range(9)]
            for key, salt, did, h1, at, top, own, p, n in zip(*columns, strict=True):
                if key is None:
                    done.append((did, h1, p, n, None))
                    continue
                suffix = _Suffix(did, h1, at, top, np.frombuffer(own, np.int64))
                if (key, salt) != run_of:
                    run_of, near = (key, salt), _Run()
                same = near.covered(suffix, NEAR_SORTED)
                done += [(did, h1, first, size, None) for first, size in suffix.spans(same)]
                rest = np.flatnonzero(~same)
                owners.append((did, h1, len(rest)))
                places.append(rest + (at - top))
                edges.append(suffix.edges[rest])
            yield _columns(done, FOUND)
            if owners:
                dids, h1s, counts = np.array(owners, dtype=np.int64).T
                p = pa.array(np.concatenate(places).astype(np.int32))
                arrays = [pa.array(np.repeat(dids, counts)), pa.array(np.repeat(h1s, counts)), p, pa.nulls(len(p), pa.int32()), pa.array(np.concatenate(edges))]
                yield pa.RecordBatch.from_arrays(arrays, ["__did", "__h1", "p", "n", "edge"])

    return ordered.mapInArrow(run, FOUND)


def _spans(candidates: DataFrame) -> DataFrame:
    found = stage(neighbours(suffixes(candidates)), "suffix-matches")
    windows = found.where("edge IS NOT NULL").select("__did", "__h1", "p", "edge")
    runs = windows.groupBy("edge").agg(F.min("__did").alias("first"), F.max("__did").alias("last"))
    # Written, so that the join's sides are plain exchanges and a window that many texts still hold is dealt to several tasks.
    runs = stage(runs.where("first < last").select("edge", "first"), "repeated-windows")
    later = windows.join(runs, "edge").where("first < __did").select("__did", "__h1", "p", F.lit(WINDOW).alias("n"))
    every = found.where("n IS NOT NULL").select("__did", "__h1", "p", "n").unionByName(later)
    return every.groupBy("__did", "__h1").agg(F.collect_list(F.struct("p", "n")).alias("__spans"))


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the passages of 50 words or more that a document with a smaller id holds too.

    A word goes if it lies in 50 consecutive words that also are in a document with a smaller id, as that document was
    before anything was removed; so one document keeps each passage. Words are runs of other characters than ASCII
    white space and are compared as they are. Adds ``n_words`` (before) and ``n_removed``; columns with these names are
    replaced. A text that is NULL, empty or has fewer than 50 words loses nothing (NULL becomes empty). Rows with equal
    ids don't take from each other; a NULL id counts as larger than all others. An empty table gives an empty table.
    Windows are 64-bit hashes.
    """
    return remove(docs, id_col, text_col, _spans)
