"""A training corpus from raw documents: the stages in order, each written and read again.

Every function takes the session, the documents its predecessor kept and the folder of the tables. All but the last
return the columns of documents, with ``n_chars`` brought up to date where the text has changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import line_dedup, minhash, packing, quality, suffix_dedup
from skytally.llm.queries import tokenizer_file
from skytally.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and are no outliers of their language and source."""
    return quality.keep_good(docs)


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; lines that three or more share stay in the last of them. A text may end up empty."""
    return _counted(line_dedup.dedup_lines(docs), docs.columns)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by shingle sets with a similarity of 0.8 or more."""
    return minhash.keep_first(docs, percent=80)


def passage_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; passages of 50 words or more stay in the first of those that hold them."""
    return _counted(suffix_dedup.dedup_passages(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the tokens of every document go: sequences of 2048."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("near dedup", near_deduplication),
    ("suffix-array dedup", passage_deduplication),
    ("packing", packed),
]

#: Neither outlier estimates nor token ids can be stated in SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of a folder of tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
