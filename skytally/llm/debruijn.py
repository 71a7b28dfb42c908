"""Repeated passages by compacting the de Bruijn graph of words.

An edge is a run of 50 words, leading from its first 49 words to its last 49. Edges that two documents hold are kept,
with the edges that precede and follow each occurrence. Where all occurrences of an edge are followed by one edge, and
all occurrences of that one preceded by the first, the path does not branch: a join of the edges with themselves finds
these links, and the source coordinates of linked edges, one word apart, number them along their path. A compacted
path is one row: its first edge, its length, a checksum of its edges. Occurrences of the first edge carry the whole
path; the checksum is verified at the coordinates of each before words go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skytally.llm.passages import WINDOW, remove, window_rows


def repeated_edges(windows: DataFrame) -> DataFrame:
    """Edges of two documents or more: ``edge``, ``first`` (smallest id), ``p0`` (place there), ``next``, ``prev``.

    ``next`` (``prev``) is the edge that follows (precedes) all occurrences, NULL if there is no such one.
    """
    # The end of a text counts as an edge of its own, so that it tells occurrences apart like any other edge.
    end = F.xxhash64("__did", "p")
    windows = windows.select(
        "edge", "__did", "p", F.coalesce("after", end).alias("after"), F.coalesce("before", end).alias("before")
    )
    one = lambda c: F.when(F.min(c) == F.max(c), F.min(c))
    edges = windows.groupBy("edge").agg(
        F.min("__did").alias("first"),
        F.max("__did").alias("last"),
        F.min_by("p", "__did").alias("p0"),
        one("after").alias("next"),
        one("before").alias("prev"),
    )
    return edges.where("first < last").drop("last")


def compact(edges: DataFrame) -> DataFrame:
    """Nonbranching paths: ``edge`` (the first), ``first``, ``n_edges``, ``sum`` (bitwise, of all edges' hashes)."""
    before = edges.select(F.col("edge").alias("prev"), F.col("next").alias("back"))
    linked = edges.join(before, "prev", "left").withColumn("linked", F.coalesce(F.col("back") == F.col("edge"), F.lit(False)))
    along = Window.partitionBy("first").orderBy("p0", "edge")
    follows = F.col("linked") & (F.lag("edge").over(along) == F.col("prev")) & (F.lag("p0").over(along) == F.col("p0") - 1)
    starts = linked.select("first", "p0", "edge", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1).alias("start"))
    numbered = starts.withColumn("path", F.sum("start").over(along))
    return numbered.groupBy("first", "path").agg(
        F.max(F.when(F.col("start") == 1, F.col("edge"))).alias("edge"),
        F.count("*").cast("int").alias("n_edges"),
        F.bit_xor("edge").alias("sum"),
    )


def _spans(candidates: DataFrame) -> DataFrame:
    windows = window_rows(candidates, ["p", "edge", "before", "after"])
    paths = compact(repeated_edges(windows)).select("edge", "first", "n_edges", "sum")
    places = window_rows(candidates, ["p", "edge"])
    found = places.join(paths, "edge").where("first < __did")
    span = F.struct("p", (F.col("n_edges") + WINDOW - 1).alias("n"), "sum")
    return found.groupBy("__did", "__h1").agg(F.collect_list(span).alias("__spans"))


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the passages of 50 words or more that a document with a smaller id holds too.

    A word goes if it lies in 50 consecutive words that also are in a document with a smaller id, as that document was
    before anything was removed; so one document keeps each passage. Words are runs of other characters than ASCII
    white space and are compared as they are. Adds ``n_words`` (before) and ``n_removed``; columns with these names are
    replaced. A text that is NULL, empty or has fewer than 50 words loses nothing (NULL becomes empty). Rows with equal
    ids don't take from each other; a NULL id counts as larger than all others. An empty table gives an empty table.
    Edges are 64-bit hashes.
    """
    return remove(docs, id_col, text_col, _spans)
