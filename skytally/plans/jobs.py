"""Complete jobs: each reads from and writes to the places it is given."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skytally.functions.calendar import as_utc, clock_timestamp
from skytally.functions.keys import payload_id
from skytally.models import classifier
from skytally.operators import asof, ranking, rollups, runs
from skytally.operators.normalise import clean, numeric, project_published
from skytally.plans.catalogue import ENTITIES, TABLES, day_partials, result_from_partials, result_table
from skytally.session import freed_exchanges, sized_for, staged
from skytally.sinks import merged
from skytally.sinks.files import delete, make_folder
from skytally.sinks.tables import (
    BATCH,
    ResultSink,
    batch_folder_writer,
    connector_batch_writer,
    counted,
    latest_view,
    write_messages,
    write_published,
)
from skytally.sources import messages, tables
from skytally.streaming import control, counts
from skytally.streaming.late import late_counts_writer
from skytally.streaming.once import once_within

BatchWriter = Callable[[DataFrame, int], None]

# Together these tell the flights of a published table apart.
FLIGHT_IDENTITY = ["FL_DATE", "OP_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST", "CRSDepTime"]
# Bytes of text up to which all rows of a day meet in one task, however many days there are. Beyond that rows move once
# more, so that copies are folded where they are read and heavy days are split.
DAYS_WHOLE_UP_TO = 1 << 37
SUMMARY_KEYS = ["Reporting_Airline", "OriginCityName", "DestCityName"]
SUMMARY_MEANS = {"avg_arrival_delay": "ArrDelayMinutes", "avg_departure_delay": "DepDelayMinutes"}


def preprocess(spark: SparkSession, source: str, target: str, by_name: bool = False) -> dict[str, int]:
    """Raw text files to the published table, in one pass over the text.

    Splits and shuffle partitions are fitted to the size of the files. Returns
    the rows read and written. Both counts ride on the write, and a stage that
    runs again after a lost executor may be counted again.
    """
    raw = tables.read_raw_csv(spark, source, by_name)
    size = tables.total_bytes(raw)
    with sized_for(spark, size, tables.text_per_byte(raw)), freed_exchanges(spark):
        # Rows move once, by date, to lose their copies and to be written, while a day fits a task.
        by_day, projected = size <= DAYS_WHOLE_UP_TO, project_published(raw)
        if by_day:
            # What follows from the route is sent near its like, where the exchange's compression finds it. Without the count in
            # between, Spark would drop the order, which the removal of copies does not ask for.
            projected = projected.sortWithinPartitions("ORIGIN", "DEST")
        # Counted above the projection: the scan still reads the published columns only.
        read, rows_read = counted(projected, "read")
        cleaned, rows_written = counted(clean(read, ["FL_DATE"] if by_day else ()), "written")
        write_published(cleaned, target, cluster=["FL_DATE"], gathered=by_day)
    return {"read": rows_read.get["rows"], "written": rows_written.get["rows"]}


def route_summary(rows: DataFrame) -> DataFrame:
    """Mean delay minutes and flights per airline and city pair."""
    return rollups.summary_by(numeric(rows, list(SUMMARY_MEANS.values())), SUMMARY_KEYS, SUMMARY_MEANS, "total_flights", "id")


def top_destinations(rows: DataFrame, k: int = 100) -> DataFrame:
    return ranking.top_counts(rows, "DestCityName", k, "count", "city")


def analyse(
    spark: SparkSession,
    source: str,
    sink: ResultSink,
    names: Iterable[str] | None = None,
    one_pass: bool = True,
    parallel: int = 4,
) -> list[str]:
    """Write the result tables of a published table.

    With ``one_pass`` the flights are read once into a table of day partials
    in the shared folder, and the result tables come from that. The table
    is written, not cached: a lost executor does not lose it. ``parallel``
    result tables are written at a time, since most of them are small.
    """
    names = list(names or TABLES)
    flights = tables.read_published(spark, source)
    with sized_for(spark, tables.total_bytes(flights)):
        if not one_pass:
            return _write_tables(names, lambda name: result_table(flights, name), sink, parallel)
        with staged(day_partials(flights), "day-partials", ["GRAIN"]) as partials:
            return _write_tables(names, lambda name: result_from_partials(partials, name), sink, parallel)


def _write_tables(names: list[str], build: Callable[[str], DataFrame], sink: ResultSink, parallel: int) -> list[str]:
    def write(name: str) -> str:
        sink.write(build(name), name, TABLES[name].id_columns)
        return name

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(inheritable_thread_target(SparkSession.active())(write), names))


def append_delay_months(
    spark: SparkSession, source: str, target: str, entity: str = "carrier", months: Sequence[tuple[int, int]] | None = None
) -> None:
    """Write the delayed days of a published table as bits by entity and month.

    With ``months`` (pairs of year and month) only these are read, and only their folders in ``target`` are replaced:
    a new month is added, or a corrected one put right, without reading the others. A month that is no longer published
    goes.
    """
    keys = ENTITIES[entity]
    flights = tables.read_published(spark, source).select(*keys, "FL_DATE", "ARR_DELAY", *runs.MONTH)
    if months is not None:
        wanted = F.lit(False)
        for year, month in months:
            wanted = wanted | ((F.col("YEAR") == year) & (F.col("MONTH") == month))
        flights = flights.filter(wanted)
    found = runs.delayed_months(flights, keys)
    written = found.hint("rebalance", *runs.MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    written.partitionBy(*runs.MONTH).parquet(f"{target}/{entity}")
    left = {tuple(r) for r in flights.select(*runs.MONTH).distinct().collect()} if months else set()  # of the few asked for
    for year, month in set(months or ()) - left:
        delete(spark, f"{target}/{entity}/YEAR={year}/MONTH={month}")


def longest_delay_runs(spark: SparkSession, target: str, entity: str = "carrier", by_year: bool = False) -> DataFrame:
    """Longest runs of delayed days from the months written by :func:`append_delay_months`, over New Year or by year."""
    return runs.longest_runs(spark.read.parquet(f"{target}/{entity}"), ENTITIES[entity], by_year)


def rotations(raw: DataFrame) -> DataFrame:
    """Flights of raw rows with the last earlier arrival of the same aircraft: where it came from and when it landed.

    An arrival is the departure plus the elapsed minutes. ``WAITED`` are the minutes on the ground, ``MOVED`` says that the
    aircraft does not leave from where it landed.
    """
    departed = clock_timestamp(F.col("FlightDate"), F.col("DepTime")).alias("DEPARTED")
    seconds = F.col("ActualElapsedTime").try_cast("double") * 60
    flown = raw.select("Tail_Number", "FlightDate", "Origin", "Dest", departed, seconds.alias("_seconds"))
    landed = F.col("DEPARTED") + F.make_dt_interval(secs=F.col("_seconds"))
    arrivals = flown.select("Tail_Number", landed.alias("LANDED"), F.col("Origin").alias("PREV_ORIGIN"), F.col("Dest").alias("PREV_DEST"))
    arrivals = arrivals.withColumn("PREV_LANDED", F.col("LANDED"))
    found = asof.asof_join(
        flown.drop("_seconds"), arrivals, ["Tail_Number"], "DEPARTED", "LANDED", ["PREV_LANDED", "PREV_ORIGIN", "PREV_DEST"]
    )
    minute = lambda c: F.floor(F.unix_micros(as_utc(c)) / 60_000_000)  # noqa: E731  without the session's zone
    return found.withColumns({"WAITED": (minute("DEPARTED") - minute("PREV_LANDED")).cast("int"), "MOVED": F.col("Origin") != F.col("PREV_DEST")})


def summarise(spark: SparkSession, source: str, sink: ResultSink, infer: bool = False) -> None:
    """Airline and city-pair summary of raw text files, keyed by its id."""
    rows = tables.read_inferred_csv(spark, source) if infer else tables.read_raw_csv(spark, source)
    sink.write(route_summary(rows), "flight_summary_batch", ["id"])


def rank_destinations(spark: SparkSession, source: str, sink: ResultSink, k: int = 100, infer: bool = False) -> None:
    """Most frequent destinations of raw text files."""
    rows = tables.read_inferred_csv(spark, source) if infer else tables.read_raw_csv(spark, source)
    sink.write(top_destinations(rows, k), "flight_wordcloud")


MODELS = {"delay": classifier.DELAY, "cancellation": classifier.CANCELLATION}


def train(spark: SparkSession, source: str, target: str, names: Iterable[str] = tuple(MODELS)) -> DataFrame:
    """Train, measure and save the classifiers of ``names``; input unfit for one of them is an error.

    Returns a row for each with its metrics and the confusion matrix of the test rows.
    """
    flights = tables.read_published(spark, source)
    results = None
    for name in names:
        _, measured, _ = classifier.fit_and_measure(flights, MODELS[name], f"{target}/{name}_prediction", FLIGHT_IDENTITY)
        results = measured if results is None else results.unionByName(measured)
    return results


def score(spark: SparkSession, source: str, model: str, target: str, preview: int = 0) -> None:
    """Apply a saved classifier to a published table; writes the flights' identity and the prediction.

    Rows without a value the model needs have no prediction and are left out. ``preview`` prints so many rows.
    """
    fitted = classifier.load_model(model)
    flights = tables.read_published(spark, source).dropna(subset=classifier.MEASURES)
    scored = classifier.score(fitted, flights)
    scored.select(*FLIGHT_IDENTITY, "prediction").write.mode("overwrite").parquet(target)
    if preview:
        classifier.score_preview(scored, classifier.label_of(fitted), preview).show(truncate=False)


def publish(
    spark: SparkSession, source: str, fmt: str, path: str | None = None, options: dict | None = None, fill: bool = False
) -> None:
    """Raw text files to JSON messages, numbers as numbers. ``fill`` sends 0.0 for empty delays."""
    rows = messages.typed_rows(tables.read_raw_csv(spark, source), fill)
    write_messages(messages.to_messages(rows), fmt, path, options)


def speed_layer(
    stream: DataFrame,
    write_raw: BatchWriter,
    write_counts: BatchWriter,
    checkpoint: str,
    interval: str | None = "30 seconds",
    state_partitions: int | None = None,
    write_windows: BatchWriter | None = None,
    lateness: str = "1 day",
    late_windows: str | None = None,
) -> tuple[StreamingQuery, ...]:
    """Start the raw append and the running count per origin city on one message stream.

    With ``write_windows``, also the count per origin city and minute of scheduled departure; ``lateness`` is how far
    behind the newest departure a message may come. With the folder ``late_windows`` the same counts are kept as
    partials there, those of messages that come later as corrections (:mod:`skytally.streaming.late`).

    Messages that may be sent again go through :func:`without_redeliveries` first.
    """
    raw = control.start(messages.parse_messages(stream), write_raw, f"{checkpoint}_raw", "append", interval)
    cities = counts.running_count(messages.parse_messages(stream), "OriginCityName")
    running = control.start(cities, write_counts, f"{checkpoint}_agg", "update", interval, state_partitions)
    started = [raw, running]
    if write_windows is not None:
        minutes = departures_per_minute(messages.parse_messages(stream), lateness)
        started.append(control.start(minutes, write_windows, f"{checkpoint}_windows", "update", interval, state_partitions))
    if late_windows is not None:
        write = late_counts_writer(late_windows, "departure", ["OriginCityName"], "1 minute", lateness)
        departed = departures(messages.parse_messages(stream))
        started.append(control.start(departed, write, f"{checkpoint}_late", "append", interval))
    return tuple(started)


def departures(flights: DataFrame) -> DataFrame:
    """Moment of scheduled departure and origin city."""
    moment = clock_timestamp(F.col("FlightDate"), F.col("CRSDepTime"))
    return flights.select(moment.alias("departure"), "OriginCityName")


def departures_per_minute(flights: DataFrame, lateness: str) -> DataFrame:
    """Flights per origin city and minute of scheduled departure, of a stream."""
    return counts.tumbling_count(departures(flights), "departure", "OriginCityName", "1 minute", lateness, "n")


def message_departure() -> Column:
    """Moment of scheduled departure in the JSON of ``value``."""
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return clock_timestamp(field("FlightDate"), field("CRSDepTime"))


def without_redeliveries(
    spark: SparkSession,
    stream: DataFrame,
    folder: str,
    checkpoint: str,
    within: str = "1 day",
    interval: str | None = "30 seconds",
    moment: Column | None = None,
    state_partitions: int | None = None,
) -> tuple[StreamingQuery, DataFrame]:
    """Start to copy each message once to a folder; returns the query and the folder as a message stream.

    Equal messages are one if the ``moment`` they speak of (the scheduled departure) is less than ``within`` behind the
    newest one. A message's id is that of its content, the same whichever of its copies was taken. Streams with states
    of their own, such as running counts, read the folder: Spark keeps one state per query in update mode. With
    ``interval`` None, wait for the query before reading.
    """
    keyed = stream.select("value", payload_id(F.col("value")).alias("id"), (message_departure() if moment is None else moment).alias("moment"))
    make_folder(spark, folder)
    once = once_within(keyed, "id", "moment", within).select("value", "id")
    query = control.start_files(once, folder, checkpoint, interval, state_partitions)
    return query, spark.readStream.schema("value string, id string").parquet(folder)


def folder_writers(target: str) -> tuple[BatchWriter, BatchWriter]:
    """Batch folders for the raw rows and for the counts."""
    return batch_folder_writer(f"{target}/raw"), batch_folder_writer(f"{target}/by_origin")


def compact(spark: SparkSession, source: str, target: str, keys: Iterable[str]) -> None:
    """The current row of each key over all batch folders below ``source``, as one table."""
    batches = spark.read.option("basePath", source).parquet(f"{source}/{BATCH}=*")
    latest_view(batches, list(keys)).write.mode("overwrite").parquet(target)


def merge(spark: SparkSession, source: str, target: str, keys: Sequence[str], buckets: int = 64, measures: Sequence[str] = ()) -> list[int]:
    """Take the batch folders below ``source`` that are new since the last time up into the table at ``target``.

    The table has the current row of each key, or with ``measures`` the sums of partial counts. Returns the buckets
    written; read the table with :func:`skytally.sinks.merged.read_merged`. Folders of old states are removed.
    """
    fold = merged.summed(keys, measures) if measures else None
    written = merged.merge_batches(spark, source, target, keys, fold, buckets)
    merged.remove_old(spark, target)
    return written


def connector_writers(sink: ResultSink) -> tuple[BatchWriter, BatchWriter]:
    """Keyed appends of the raw rows and of the counts."""
    return connector_batch_writer(sink, "raw"), connector_batch_writer(sink, "by_origin")
