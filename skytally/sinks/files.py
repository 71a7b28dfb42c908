"""Small files and folders on whatever file system Spark uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    where, system = _at(spark, folder)
    if not system.exists(where):
        return []
    return [entry.getPath().getName() for entry in system.listStatus(where)]


def read_text(spark: SparkSession, path: str) -> str:
    where, system = _at(spark, path)
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole or not at all: under another name first, then renamed. An existing file is an error."""
    where, system = _at(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{where.getParent()}/.{where.getName()}.{spark._jvm.java.util.UUID.randomUUID()}")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(where) or not system.rename(draft, where):
        system.delete(draft, False)
        raise FileExistsError(path)


def make_folder(spark: SparkSession, path: str) -> None:
    where, system = _at(spark, path)
    system.mkdirs(where)


def delete(spark: SparkSession, path: str) -> None:
    where, system = _at(spark, path)
    system.delete(where, True)
