"""Result tables, the published table and per-batch folders."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skytally.functions.keys import safe_id, single_id
from skytally.operators.ranking import latest_per_key

BATCH = "batch_id"


def write_published(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("YEAR", "MONTH"),
    cluster: Sequence[str] = (),
    date: str = "FL_DATE",
    gathered: bool = False,
) -> None:
    """Overwrite a Parquet table partitioned by date columns.

    The rebalance step gathers rows that agree on ``cluster`` (by default the
    partition columns), so that a folder gets few files, while runtime planning
    splits groups that are larger than the advised size and merges small ones.
    No task count is fixed here. For very large tables cluster by the date:
    a file then holds few days, and later daily aggregates combine well before
    their exchange. Files are sorted by date, which lets scans skip row groups.
    Rows that an earlier step has already ``gathered`` are written where they are.
    """
    rows = df if gathered else df.hint("rebalance", *(cluster or by))
    rows.sortWithinPartitions(*by, date).write.mode("overwrite").partitionBy(*by).parquet(path)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, and their count as a side product of the next action on them."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


@dataclass(frozen=True)
class ResultSink:
    """Where result tables go.

    ``target`` is a folder, or a name prefix for a connector that addresses
    tables with the option ``name_option``. ``id_option`` names the connector's
    option for the document id column.
    """

    target: str
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    name_option: str = "path"
    id_option: str | None = None
    separator: str = "/"

    def write(self, df: DataFrame, name: str, id_columns: Sequence[str] = (), mode: str = "overwrite") -> None:
        """Write one table. Several id columns are joined into an ``id`` column; no id is NULL."""
        options = dict(self.options) | {self.name_option: self.location(name)}
        if id_columns and self.id_option:
            keyed = id_columns[0] if len(id_columns) == 1 else "id"
            df = df.withColumn(keyed, single_id(keyed) if len(id_columns) == 1 else safe_id(id_columns))
            options[self.id_option] = keyed
        df.write.format(self.fmt).options(**options).mode(mode).save()

    def location(self, name: str) -> str:
        return f"{self.target}{self.separator}{name}"


def search_index_sink(prefix: str, nodes: str, id_option: str = "es.mapping.id") -> ResultSink:
    """Sink for the search index connector, whose jar the cluster supplies."""
    return ResultSink(
        target=prefix,
        fmt="org.elasticsearch.spark.sql",
        options={"es.nodes": nodes},
        name_option="es.resource",
        id_option=id_option,
        separator="",
    )


def write_messages(messages: DataFrame, fmt: str, path: str | None = None, options: Mapping[str, str] | None = None) -> None:
    """Publish a ``value`` column: to a broker with ``kafka``, as JSON lines with ``text``."""
    writer = messages.select("value").write.format(fmt).options(**(options or {})).mode("append")
    writer.save(path) if path else writer.save()


def batch_folder_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch callback that gives every batch its own folder.

    A batch that is run again replaces its folder, so its rows do not appear
    twice. Runtime planning gathers the emitted rows into files of the advised size.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def connector_batch_writer(
    sink: ResultSink, name: str, id_columns: str | Sequence[str] = "id"
) -> Callable[[DataFrame, int], None]:
    """Micro-batch callback that appends to a keyed connector; a repeated id replaces its document.

    Several id columns are joined into ``id``. A sink without ids would hold the rows of a repeated batch twice, so it is refused.
    """
    if not sink.id_option:
        raise ValueError("a sink of micro-batches needs ids; write batch folders instead")

    def write(batch: DataFrame, batch_id: int) -> None:
        sink.write(batch, name, [id_columns] if isinstance(id_columns, str) else id_columns, mode="append")

    return write


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """All batch folders below ``path`` with their number; no rows if nothing was written."""
    try:
        return spark.read.option("basePath", path).schema(schema).parquet(f"{path}/{BATCH}=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema).withColumn(BATCH, F.lit(0))


def latest_view(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current row of each key over all batches: what an upserting sink would hold."""
    return latest_per_key(batches, keys, [BATCH]).drop(BATCH)
