"""Delimited text, Parquet and file listings."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from skytally.schemas import CLOCK_COLUMNS, PROCESSED_SCHEMA, RAW_COLUMNS

LISTING_SCHEMA = "path string, file_name string, bytes bigint, modified timestamp"


def read_raw_csv(spark: SparkSession, path: str | Sequence[str], by_name: bool = False) -> DataFrame:
    """Raw rows as text; ``path`` may be a file, a folder or a glob.

    Columns are expected as declared; ``by_name`` expects those of the first
    file's header instead, for files that hold other columns or another order.
    Planning reads that header only, but every file's own header is compared
    when the file is read, and a file that differs fails with its name.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.option("header", True)
    found = reader.csv(paths).columns
    # The unnamed column that a comma at the end of the line makes.
    trailing = [""] if found[-1] == f"_c{len(found) - 1}" else []
    names = [*(found[: len(found) - len(trailing)] if by_name else RAW_COLUMNS), *trailing]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    read = reader.option("enforceSchema", False).schema(schema).csv(paths)
    return read.select([(F.col(c) if c in names else F.lit(None).cast("string")).alias(c) for c in RAW_COLUMNS])


def read_inferred_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    sampling_ratio: float = 1.0,
    text_columns: Sequence[str] = tuple(CLOCK_COLUMNS),
) -> DataFrame:
    """Rows with inferred types, at the price of one more pass over the text.

    ``text_columns`` stay text whatever they look like: ``0856`` read as a
    number would lose its zero.
    """
    reader = spark.read.option("header", True)
    paths = [path] if isinstance(path, str) else list(path)
    inferred = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio).csv(paths).schema
    kept = set(text_columns)
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in kept else f for f in inferred])
    return spark.read.option("header", True).schema(schema).csv(paths)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The published table, in its declared column order.

    Filters on YEAR and MONTH prune folders when the table is partitioned by them.
    """
    return spark.read.schema(PROCESSED_SCHEMA).parquet(path).select(*PROCESSED_SCHEMA.names)


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Persist the named columns for several uses; spills to disk. Call ``unpersist`` after use."""
    return df.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)


def list_files(spark: SparkSession, folder: str | Sequence[str], glob: str = "*") -> DataFrame:
    """Files below a folder or folders. Contents are not read; a missing folder gives no rows."""
    try:
        found = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob)
            .load(folder if isinstance(folder, str) else list(folder))
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING_SCHEMA)
    return found.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


# Bytes of text in a byte of a compressed file, roughly.
TEXT_IN_COMPRESSED = 8


def total_bytes(scan: DataFrame) -> int:
    """Size of all files of a scan, as its plan states it; no job is run. Compressed text counts as the text it holds."""
    leaves = scan._jdf.queryExecution().analyzed().collectLeaves()
    stated = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    return int(stated * (1 + _share_compressed(scan) * (TEXT_IN_COMPRESSED - 1)))


def text_per_byte(scan: DataFrame) -> int:
    """Bytes of text in a byte of a scan's files, roughly, if most are compressed; else 1."""
    return TEXT_IN_COMPRESSED if _share_compressed(scan) > 0.5 else 1


def _share_compressed(scan: DataFrame) -> Fraction:
    files = scan.inputFiles()
    return Fraction(sum(name.endswith((".gz", ".bz2", ".zst")) for name in files), max(1, len(files)))


def rows_per_file(files: DataFrame, scan: DataFrame) -> DataFrame:
    """The listed files (of :func:`list_files`) with ``row_count``; 0 for a file from which the scan reads no row.

    Files are matched by their full path: tasks of one write use the same name in every folder.
    """
    plain = lambda path: F.regexp_replace(path, "^([a-z0-9]+:)/*", "$1/")  # noqa: E731  file:/x and file:///x are one
    counted = scan.groupBy(F.col("_metadata.file_path").alias("_at")).agg(F.count("*").alias("row_count"))
    # The scan's path is encoded as a URI, the listing's is not.
    decoded = F.url_decode(F.replace(F.col("_at"), F.lit("+"), F.lit("%2B")))
    joined = files.withColumn("_at", plain(F.col("path"))).join(counted.withColumn("_at", plain(decoded)), "_at", "left")
    return joined.select(*files.columns, F.coalesce("row_count", F.lit(0)).alias("row_count"))
