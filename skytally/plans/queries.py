"""Registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.errors import StreamingQueryException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions.calendar import calendar_parts
from skytally.models import classifier
from skytally.operators import asof, changes, concurrency, legs, normalise, ranking, rollups, runs, sampling, sketches
from skytally.plans import catalogue, jobs
from skytally.schemas import PROCESSED_SCHEMA
from skytally.session import freed_exchanges, stage, work_folder
from skytally.sinks import merged
from skytally.sinks.tables import ResultSink, batch_folder_writer, latest_view, read_batches, write_messages
from skytally.sources import messages, tables
from skytally.sources.star import flights, raw_flights
from skytally.streaming import control, counts, late

Query = Callable[[SparkSession, str], DataFrame]

SHOWN = PROCESSED_SCHEMA.names
# What ``dedup_flights`` shows.
TYPED = [
    "FL_DATE", "OP_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "OriginCityName", "DEST", "DestCityName",
    "DEP_DELAY", "DepDelayMinutes", "ARR_DELAY", "ArrDelayMinutes", "CANCELLED", "CANCELLATION_CODE", "DIVERTED",
    "DISTANCE", "YEAR", "MONTH", "DAYOFMONTH", "DAYOFWEEK", "IS_DELAY",
]
# The fields that tell flights of the star apart; sampling goes by them.
IDENTITY = ["FL_DATE", "OP_CARRIER_FL_NUM", "OP_CARRIER", "ORIGIN", "DEST"]
# Two of them do so alone, and are columns of the line items: a filter on them reaches the scan.
SCAN_IDENTITY = ["FL_DATE", "OP_CARRIER_FL_NUM"]

EVENT_SCHEMA = (
    T.StructType()
    .add("event_id", T.LongType())
    .add("ts", T.TimestampNTZType())
    .add("user_id", T.LongType())
    .add("event_type", T.StringType())
    .add("value", T.DoubleType())
    .add("props", T.StringType())
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


# Result tables ---------------------------------------------------------------


def _result_table(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    table = catalogue.TABLES[name]
    return catalogue.result_table(flights(spark, sf_dir, *table.columns), name)


def airline_route_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.route_summary(flights(spark, sf_dir, *jobs.SUMMARY_KEYS, *jobs.SUMMARY_MEANS.values()))


def top_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.top_destinations(flights(spark, sf_dir, "DestCityName"))


def grain_rollup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.all_grains(flights(spark, sf_dir, *catalogue.INPUT_COLUMNS))


def day_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table the one-pass job derives all result tables from."""
    return catalogue.day_partials(flights(spark, sf_dir, *catalogue.INPUT_COLUMNS))


# Tables that are added to ------------------------------------------------------


def _delay_months(entity: str, spark: SparkSession, sf_dir: str) -> str:
    """The months of a published table written in three goes, one of them twice."""
    keys, folder = catalogue.ENTITIES[entity], work_folder(spark, "delay-months")
    columns = [*keys, "FL_DATE", "ARR_DELAY", *runs.MONTH]
    published = flights(spark, sf_dir, *columns).withColumn("ARR_DELAY", F.col("ARR_DELAY").cast("float"))
    published.write.partitionBy(*runs.MONTH).parquet(f"{folder}/published")
    known = [tuple(r) for r in published.select(*runs.MONTH).distinct().orderBy(*runs.MONTH).collect()]
    third = len(known) // 3
    for part in (known[third:], known[: third + 2], known[: third + 1]):
        jobs.append_delay_months(spark, f"{folder}/published", f"{folder}/months", entity, part)
    return f"{folder}/months"


def delay_runs(entity: str, by_year: bool, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest runs of delayed days from months that were added one after the other."""
    return jobs.longest_delay_runs(spark, _delay_months(entity, spark, sf_dir), entity, by_year)


def _publishes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two publishes of the orders: some new, some gone, some priced anew, some copies more or less."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders = orders.withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("long")).drop("o_totalprice")
    key = F.col("o_orderkey")
    old = orders.filter(key % 11 != 0).unionByName(orders.filter(key % 13 == 0))
    new = orders.withColumn("cents", F.col("cents") + F.when(key % 17 == 0, 100).otherwise(0)).filter(key % 7 != 0)
    return old, new.unionByName(new.filter(key % 19 == 0))


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.changes(*_publishes(spark, sf_dir))


def changes_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new publish, from the old one and the changes."""
    old, new = _publishes(spark, sf_dir)
    return changes.apply_changes(old, changes.changes(old, new))


def refreshed_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums by priority and status, of the old publish, brought up to date from the changes alone."""
    old, new = _publishes(spark, sf_dir)
    keys, measures = ["o_orderpriority", "o_orderstatus"], {"cents": F.col("cents")}
    before = stage(changes.partials_of(old, keys, measures), "partials")
    return changes.refresh_partials(before, changes.changes(old, new), keys, measures)


# Joins and sweeps in time -------------------------------------------------------


def asof_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the last click of the same user at or before it."""
    of = lambda kind: events(spark, sf_dir).filter(F.col("event_type") == kind)
    clicks = of("click").select("user_id", "ts", F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id"))
    bought = of("purchase").select("event_id", "user_id", "ts")
    return asof.asof_join(bought, clicks, ["user_id"], "ts", "ts", ["click_ts", "click_id"])


def asof_previous_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with the customer's last order of an earlier day, cut in time as if a task held 4 rows of a customer."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    earlier = orders.select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("prev_orderkey"))
    return asof.asof_join(orders, earlier, ["o_custkey"], "o_orderdate", "o_orderdate", ["prev_orderkey"], True, 4)


def _open_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_shipdate", "l_returnflag"]
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*columns)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def open_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items between order and shipment, by return flag, at every moment their number changes."""
    return concurrency.open_intervals(_open_items(spark, sf_dir), "o_orderdate", "l_shipdate", ["l_returnflag"])


def open_items_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concurrency.peak(open_items(spark, sf_dir), ["l_returnflag"])


# Sketches and groups of columns ---------------------------------------------------


def distinct_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct flight numbers and dates at all grains from sketches by day, and whether they are within 5 % of the exact count."""
    finest, counted = ["OP_CARRIER", "ORIGIN", "DEST", "YEAR", "MONTH", "DAYOFWEEK"], ["OP_CARRIER_FL_NUM", "FL_DATE"]
    calendar = {name: part for name, part in calendar_parts(F.col("FL_DATE")).items() if name in finest}
    rows = flights(spark, sf_dir, *[c for c in finest if c not in calendar], *counted)
    # A group of the finest keys has few rows, so these meet before they become sketches; a heavy group is split.
    group = F.pmod(F.hash("OP_CARRIER", "ORIGIN", "DEST"), F.lit(1 << 16))
    met = rows.withColumn("_group", group).hint("rebalance", "_group").drop("_group").withColumns(calendar)
    partials = sketches.sketch_partials(met.withColumn("FL_DATE", F.unix_date("FL_DATE")), finest, counted)
    keys, shown = ["GRAIN", *finest], [f"{c}_EXACT" for c in counted]
    found = sketches.estimates(sketches.sketches_at(partials, catalogue.ALL_GRAINS, counted), keys, counted)
    exact = rollups.distinct_counts(rows, catalogue.ALL_GRAINS, *counted, shown, calendar)
    same = F.lit(True)
    for key in keys:
        same = same & found[key].eqNullSafe(exact[key])
    joined = found.join(exact, same, "left").select(
        *[found[k] for k in keys], *[f"{c}_DISTINCT" for c in counted], *[F.coalesce(c, F.lit(0)).alias(c) for c in shown]
    )
    near = [(F.abs(F.col(f"{c}_DISTINCT") - F.col(f"{c}_EXACT")) <= 0.05 * F.col(f"{c}_EXACT")).alias(f"{c}_NEAR") for c in counted]
    return joined.select(*keys, *shown, *near)


def quantile_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of arrival delays by carrier from sketches by carrier and day: whether their true ranks are within the error."""
    rows = flights(spark, sf_dir, "OP_CARRIER", "FL_DATE", "ARR_DELAY")
    partials = sketches.sketch_partials(rows, ["OP_CARRIER", "FL_DATE"], measures=["ARR_DELAY"])
    merged_ = sketches.merge_sketches(partials, ["OP_CARRIER"], measures=["ARR_DELAY"])
    ranks = [0.1, 0.5, 0.9]
    found = sketches.estimates(merged_, ["OP_CARRIER"], quantiles={"ARR_DELAY": ranks})
    values = F.explode(F.array(*[F.struct(F.lit(round(100 * r)).alias("percent"), F.col(f"ARR_DELAY_Q{round(100 * r)}").alias("value")) for r in ranks]))
    asked = found.select("OP_CARRIER", values.alias("_v")).select("OP_CARRIER", "_v.*")
    delays = rows.filter(F.col("ARR_DELAY").isNotNull()).groupBy("OP_CARRIER", "ARR_DELAY").agg(F.count("*").alias("n"))
    ranked = delays.join(asked, "OP_CARRIER").groupBy("OP_CARRIER", "percent").agg(
        F.sum(F.when(F.col("ARR_DELAY") < F.col("value"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("ARR_DELAY") <= F.col("value"), F.col("n")).otherwise(0)).alias("upto"),
        F.sum("n").alias("n"),
    )
    error, rank = sketches.RANK_ERROR * F.col("n"), F.col("percent") / 100 * F.col("n")
    near = (rank >= F.col("below") - error - 1) & (rank <= F.col("upto") + error + 1)
    return ranked.select("OP_CARRIER", "percent", "n", near.alias("near"))


LEG_FIELDS = ["Part", "Quantity", "Ship"]


def legs_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items folded into groups of columns of their order, and unfolded again. One of those with equal numbers stays."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "l_orderkey", "l_linenumber AS LEG", "l_partkey AS Part", "l_quantity AS Quantity", "l_shipdate AS Ship"
    )
    wide = legs.from_legs(items, ["l_orderkey"], LEG_FIELDS, 7)
    return legs.to_legs(wide, ["l_orderkey"], LEG_FIELDS, 7)


# Ingestion -------------------------------------------------------------------


def normalise_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise.normalise(raw_flights(spark, sf_dir)).select(*SHOWN)


def calendar_of_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = flights(spark, sf_dir, "FL_DATE").distinct()
    return dates.select("FL_DATE", *[part.alias(name) for name, part in calendar_parts(F.col("FL_DATE")).items()])


def delay_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flights(spark, sf_dir, "FL_DATE", "ARR_DELAY")
    return rollups.count_by(normalise.add_derived(rows), ["ARR_DELAY", "IS_DELAY"], "n")


def dedup_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies planted by a union with itself."""
    rows = flights(spark, sf_dir, *TYPED)
    return normalise.drop_copies(rows.unionByName(rows))


def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = normalise.required(flights(spark, sf_dir, *classifier.DELAY.columns), classifier.DELAY.needed)
    return rollups.count_by(complete, ["OP_CARRIER", "ORIGIN"], "n")


def _staged_csv(spark: SparkSession, sf_dir: str) -> str:
    """Text files of the raw rows. They are mostly commas, so compressed; such a file is read by one task, so its rows are bounded."""
    folder = work_folder(spark, "raw-csv")
    bounded = {"header": True, "compression": "gzip", "maxRecordsPerFile": 1_000_000}
    with freed_exchanges(spark):
        raw_flights(spark, sf_dir).write.options(**bounded).csv(folder)
    return folder


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files written and read back under the declared schema, then normalised."""
    return normalise.normalise(tables.read_raw_csv(spark, _staged_csv(spark, sf_dir))).select(*SHOWN)


def csv_inferred_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.route_summary(tables.read_inferred_csv(spark, _staged_csv(spark, sf_dir)))


def csv_top_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A glob of text files instead of a folder."""
    return jobs.top_destinations(tables.read_raw_csv(spark, f"{_staged_csv(spark, sf_dir)}/*.csv.gz"))


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole preparation job: text files to the published table, read back."""
    target = work_folder(spark, "published")
    jobs.preprocess(spark, _staged_csv(spark, sf_dir), target)
    return tables.read_published(spark, target).select(*SHOWN)


def ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a partitioned folder of line items, and of an empty table, with their row counts, by folder."""
    folder = work_folder(spark, "manifest")
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.month("l_shipdate").alias("month"), "l_orderkey")
    items.write.partitionBy("month").parquet(f"{folder}/items")
    items.where("false").select("l_orderkey").write.parquet(f"{folder}/none")
    listed = tables.list_files(spark, [f"{folder}/items", f"{folder}/none"], "*.parquet")
    scan = spark.read.schema("l_orderkey long").parquet(f"{folder}/items/*", f"{folder}/none")
    found = tables.rows_per_file(listed, scan)
    month = F.regexp_extract("path", "(month=[0-9]+)", 1)
    return found.groupBy(F.when(month != "", month).otherwise("empty").alias("folder")).agg(
        F.sum("row_count").alias("row_count"), F.bool_and(F.col("row_count") == 0).alias("empty")
    )


def sink_document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result table through a sink with ids, read back. A file format takes the id option without using it."""
    sink = ResultSink(work_folder(spark, "sink"), "json", id_option="id_column")
    sink.write(_result_table("delay_total_src_dest", spark, sf_dir), "delays", ["ORIGIN", "DEST"])
    schema = "id string, ORIGIN string, DEST string, AVG_DEP_DELAY double, AVG_ARR_DELAY double"
    return spark.read.schema(schema).json(sink.location("delays"))


def sink_top_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking job, from text files to its sink."""
    sink = ResultSink(work_folder(spark, "sink"))
    jobs.rank_destinations(spark, _staged_csv(spark, sf_dir), sink)
    return spark.read.parquet(sink.location("flight_wordcloud"))


def counts_on_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and written by the preparation job, as counted on the way."""
    found = jobs.preprocess(spark, _staged_csv(spark, sf_dir), work_folder(spark, "published"))
    return spark.createDataFrame([(found["read"], found["written"])], "rows_read long, rows_written long")


def sorted_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of a result table in the order of its keys."""
    ordered = ranking.ordered(_result_table("delay_year_month_carrier", spark, sf_dir), ["OP_CARRIER", "YEAR", "MONTH"])
    return ranking.preview(ordered, 20)


def kept_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns persisted for several uses; Spark reads persisted rows again only if an executor is lost."""
    kept = tables.keep(flights(spark, sf_dir, "ORIGIN", "DEST", "YEAR"), ["ORIGIN", "YEAR"])
    return kept.groupBy("YEAR").agg(F.count("*").alias("n"), F.count_distinct("ORIGIN").alias("origins"))


# Messages --------------------------------------------------------------------


def wire_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.parse_messages(messages.to_messages(events(spark, sf_dir)), EVENT_SCHEMA)


def delay_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed messages of the flights, parsed under the wire schema."""
    typed = messages.to_messages(messages.typed_rows(raw_flights(spark, sf_dir), fill=True))
    keys = ["Origin", "Dest", "Cancelled"]
    summed = ["DepDelay", "ArrDelay", "CarrierDelay", "Distance", "TaxiOut", "CRSDepTime"]
    parsed = messages.parse_messages(typed, columns=[*keys, *summed])
    return parsed.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sum("DepDelay").alias("dep_delay"),
        F.sum("ArrDelay").alias("arr_delay"),
        F.sum("CarrierDelay").alias("carrier_delay"),
        F.sum("Distance").alias("distance"),
        F.count("TaxiOut").alias("n_taxi_out"),
        F.min(F.col("CRSDepTime").cast("int")).alias("first_clock"),
    )


def wire_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight messages as published by default, parsed and summed up: empty numbers stay empty."""
    fields = raw_flights(spark, sf_dir, "Origin", "DestCityName", "ArrDelay", "Distance", "CancellationCode", "TaxiOut")
    parsed = messages.parse_messages(messages.to_messages(messages.typed_rows(fields)))
    return parsed.groupBy("Origin", "DestCityName", "CancellationCode").agg(
        F.count("ArrDelay").alias("n_arr_delay"),
        F.sum("ArrDelay").alias("arr_delay"),
        F.sum("Distance").alias("distance"),
        F.count("TaxiOut").alias("n_taxi_out"),
    )


# Streams ---------------------------------------------------------------------


# Parts in which a stream's input arrives. Each run takes it in about so many micro-batches.
SLICES = 6


def _arrive(rows: DataFrame, moment: str, write: Callable[[DataFrame], None]) -> str:
    """Write rows in slices of time, one after the other, as a source would see them arrive.

    Returns how far a row may come behind the newest one: files of two slices can meet in a micro-batch.
    """
    second = F.col(moment).cast("timestamp").cast("double")
    low, high = rows.agg(F.min(second), F.max(second)).first()
    width = (high - low) / SLICES + 1 if low is not None else 1
    place = F.coalesce(F.floor((second - (low or 0)) / width), F.lit(0))
    for i in range(SLICES):
        write(rows.filter(place == i))
    return f"{int(2 * width) + 3600} seconds"


def _limit(spark: SparkSession, folder: str, files: int | None) -> dict[str, str]:
    """Files of a micro-batch, as given or so that there are :data:`SLICES` of them."""
    return {"maxFilesPerTrigger": str(files or -(-tables.list_files(spark, folder, "part-*").count() // SLICES) or 1)}


def _event_stream(spark: SparkSession, sf_dir: str, files: int | None = None) -> tuple[DataFrame, str]:
    """The event table as an unbounded source that arrives in the order of time, and its lateness."""
    folder = work_folder(spark, "events")
    lateness = _arrive(events(spark, sf_dir), "ts", lambda part: part.write.mode("append").parquet(folder))
    reader = spark.readStream.schema(EVENT_SCHEMA).options(**_limit(spark, folder, files))
    return reader.parquet(folder), lateness


def _batches(spark: SparkSession, stream: DataFrame, purpose: str, mode: str) -> DataFrame:
    folder = work_folder(spark, purpose)
    control.run_available(stream, batch_folder_writer(f"{folder}/out"), f"{folder}/checkpoint", mode)
    return read_batches(spark, f"{folder}/out", stream.schema)


def stream_raw_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines, read as a stream, parsed, appended with their ids."""
    folder = work_folder(spark, "messages")
    write_messages(messages.to_messages(events(spark, sf_dir)), "text", folder)
    stream = messages.parse_messages(messages.message_stream(spark, "text", path=folder), EVENT_SCHEMA)
    appended = _batches(spark, stream, "raw-append", "append")
    line = F.to_json(F.struct(*EVENT_SCHEMA.names), messages.JSON_OPTIONS)
    return appended.select(
        *EVENT_SCHEMA.names, F.length("id").alias("id_length"), (F.col("id") == F.sha2(line, 256)).alias("id_is_digest")
    )


def stream_running_count(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    counted = counts.running_count(_event_stream(spark, sf_dir, files)[0], "event_type")
    return latest_view(_batches(spark, counted, "running-count", "update"), ["id"])


def stream_tumbling_count(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    stream, lateness = _event_stream(spark, sf_dir, files)
    counted = counts.tumbling_count(stream, "ts", "event_type", "1 hour", lateness, "n")
    return latest_view(_batches(spark, counted, "tumbling", "update"), ["window_start", "event_type"])


def _flight_stream(spark: SparkSession, sf_dir: str, files: int | None = None) -> tuple[DataFrame, str]:
    """Flight messages as a stream of JSON lines in the order of their dates, and its lateness."""
    folder = work_folder(spark, "flight-messages")
    names = ["FlightDate", "CRSDepTime", "OriginCityName"]
    fields = raw_flights(spark, sf_dir, *names)
    lines = stage(messages.to_messages(fields).withColumn("day", F.get_json_object("value", "$.FlightDate").try_cast("date")), "lines")
    lateness = _arrive(lines, "day", lambda part: write_messages(part, "text", folder))
    stream = messages.message_stream(spark, "text", _limit(spark, folder, files), folder)
    return messages.parse_messages(stream, columns=names), lateness


def flight_summary_speed(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """Running count of flights per origin city."""
    counted = counts.running_count(_flight_stream(spark, sf_dir, files)[0], "OriginCityName")
    return latest_view(_batches(spark, counted, "speed", "update"), ["id"])


def stream_origin_minutes(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """Flights per origin city and minute of scheduled departure."""
    stream, lateness = _flight_stream(spark, sf_dir, files)
    counted = jobs.departures_per_minute(stream, lateness)
    latest = latest_view(_batches(spark, counted, "minutes", "update"), ["window_start", "OriginCityName"])
    return latest.select("window_start", "OriginCityName", "n")


def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in two slices, then one early day once more.

    The repeated day comes long after its windows have closed, so the
    watermark drops it. Windows that are still open at the end are not emitted.
    """
    folder = work_folder(spark, "late")
    rows, ts = events(spark, sf_dir), F.col("ts")
    middle, early, after = [F.lit(day).cast("timestamp_ntz") for day in ("2024-01-15", "2024-01-05", "2024-01-06")]
    # Each slice arrives while the query is down; the restart takes it up as one micro-batch.
    for arrived in (ts < middle, ts >= middle, (ts >= early) & (ts < after)):
        rows.filter(arrived).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(EVENT_SCHEMA).parquet(f"{folder}/in")
        counted = counts.tumbling_count(stream, "ts", "event_type", "1 hour", "1 hour", "n")
        control.run_available(counted, batch_folder_writer(f"{folder}/out"), f"{folder}/checkpoint", "append")
    emitted = read_batches(spark, f"{folder}/out", counted.schema)
    return emitted.select("window_start", "window_end", "event_type", "n")


def stream_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running count with a processing-time trigger, which takes the files in several micro-batches until none is left."""
    stream, _ = _event_stream(spark, sf_dir)
    counted, folder = counts.running_count(stream, "event_type"), work_folder(spark, "interval")
    write = batch_folder_writer(f"{folder}/out")
    query = control.start(counted, write, f"{folder}/checkpoint", "update", "1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return latest_view(read_batches(spark, f"{folder}/out", counted.schema), ["id"])


def stream_batch_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended by a sink that fails once behind its second batch: the error comes out, and a restart loses and repeats nothing."""
    stream, _ = _event_stream(spark, sf_dir)
    folder, failures = work_folder(spark, "batch-error"), []
    write = batch_folder_writer(f"{folder}/out")

    def failing(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("the sink is gone")

    try:
        control.run_available(stream, failing, f"{folder}/checkpoint")
    except StreamingQueryException as error:
        seen = "the sink is gone" in str(error)
    else:
        seen = not failures  # fewer than two batches
    control.run_available(stream, failing, f"{folder}/checkpoint")
    appended = read_batches(spark, f"{folder}/out", stream.schema)
    return appended.groupBy("event_type").agg(F.count("*").alias("n"), F.lit(seen).alias("error_seen"))


def _sent_again(spark: SparkSession, sf_dir: str, files: int | None = None) -> tuple[DataFrame, str]:
    """The events as messages, some of them twice or three times: again in their own slice, and in the next one."""
    folder, before = work_folder(spark, "sent-again"), []

    def send(part: DataFrame) -> None:
        again = [part.filter("event_id % 5 = 0"), *[earlier.filter("event_id % 7 = 0") for earlier in before[-1:]]]
        before.append(part)
        for more in again:
            part = part.unionByName(more)
        write_messages(messages.to_messages(part), "text", folder)

    lateness = _arrive(events(spark, sf_dir), "ts", send)
    return messages.message_stream(spark, "text", _limit(spark, folder, files), folder), lateness


def _once(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    stream, lateness = _sent_again(spark, sf_dir, files)
    folder = work_folder(spark, "once")
    moment = F.get_json_object("value", "$.ts").try_cast("timestamp_ntz")
    query, once = jobs.without_redeliveries(
        spark, stream, f"{folder}/messages", f"{folder}/checkpoint", lateness, None, moment
    )
    control.await_end(query)
    return once


def stream_once(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """Messages of which some are sent again, in their own micro-batch and in a later one; each comes out once."""
    appended = _batches(spark, messages.parse_messages(_once(spark, sf_dir, files), EVENT_SCHEMA), "once-raw", "append")
    return appended.select(*EVENT_SCHEMA.names)


def stream_once_count(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """A running count behind the removal of messages sent again."""
    counted = counts.running_count(messages.parse_messages(_once(spark, sf_dir, files), EVENT_SCHEMA), "event_type")
    return latest_view(_batches(spark, counted, "once-count", "update"), ["id"])


def _late_partials(spark: SparkSession, sf_dir: str) -> str:
    """Hourly partial counts of the events, of which one early day comes twice, the second time behind all others."""
    folder = work_folder(spark, "late-kept")
    rows, ts = events(spark, sf_dir), F.col("ts")
    middle, early, after = [F.lit(day).cast("timestamp_ntz") for day in ("2024-01-15", "2024-01-05", "2024-01-06")]
    for arrived in (ts < middle, ts >= middle, (ts >= early) & (ts < after)):
        rows.filter(arrived).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(EVENT_SCHEMA).parquet(f"{folder}/in")
        write = late.late_counts_writer(f"{folder}/out", "ts", ["event_type"], "1 hour", "1 hour")
        control.run_available(stream, write, f"{folder}/checkpoint")
    return f"{folder}/out"


EVENT_TYPE = T.StructType([EVENT_SCHEMA["event_type"]])


def stream_late_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts with late rows: all rows, those in time and those behind their window's end."""
    partials = late.read_partials(spark, _late_partials(spark, sf_dir), EVENT_TYPE)
    return late.counts_with_late(partials, ["event_type"])


def stream_closed_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows as they were when they closed, with their corrections added afterwards."""
    folder = _late_partials(spark, sf_dir)
    partials = late.read_partials(spark, folder, EVENT_TYPE)
    closed = late.closed_windows(partials, late.closed_by(spark, folder), ["event_type"])
    more = late.corrections(partials, ["event_type"]).drop("batch_id")
    return closed.unionByName(more).groupBy("window_start", "window_end", "event_type").agg(F.sum("n").alias("n"))


def merged_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts per user in micro-batches, taken up one after the other by a table in buckets."""
    stream, _ = _event_stream(spark, sf_dir)
    counted, folder = counts.running_count(stream, "user_id", "n"), work_folder(spark, "merged")
    control.run_available(counted, batch_folder_writer(f"{folder}/out"), f"{folder}/checkpoint", "update")
    for number in range(SLICES + 1):
        merged.merge_batches(spark, f"{folder}/out", f"{folder}/table", ["user_id"], buckets=16, upto=number)
    jobs.merge(spark, f"{folder}/out", f"{folder}/table", ["user_id"])
    return merged.read_merged(spark, f"{folder}/table").select("user_id", "n", "id")


def merged_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial counts with late ones, added up in a table in buckets batch by batch."""
    folder, keys = _late_partials(spark, sf_dir), ["window_start", "window_end", "event_type"]
    target = work_folder(spark, "merged-sums")
    for number in range(2):
        merged.merge_batches(spark, f"{folder}/partials", target, keys, merged.summed(keys, ["n"]), 8, upto=number)
    jobs.merge(spark, f"{folder}/partials", target, keys, 8, ["n"])
    return merged.read_merged(spark, target).select(*keys, "n")


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.latest_per_key(events(spark, sf_dir), ["user_id"], ["ts", "event_id"])


# Sampling and classification -------------------------------------------------


def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flights(spark, sf_dir, *IDENTITY, "DISTANCE")
    return sampling.bucket_sample(rows, IDENTITY, 0.2, salt="sample", portable=True)


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flights(spark, sf_dir, *IDENTITY)
    parts = sampling.bucket_split(rows, IDENTITY, {"train": 0.8, "test": 0.2}, salt="split", portable=True)
    return rollups.count_by(parts, ["PART", "OP_CARRIER"], "n")


def label_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted over the pairs of labels, of which there are few, so that no row is expanded."""
    pairs = flights(spark, sf_dir, "CANCELLED", "IS_DELAY").groupBy("CANCELLED", "IS_DELAY").agg(F.count("*").alias("n"))
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.count_distinct("CANCELLED").alias("cancel_classes"),
        F.count_distinct("IS_DELAY").alias("delay_classes"),
    )


def ml_string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.category_indexes(flights(spark, sf_dir, "DestCityName"), "DestCityName")


def ml_feature_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [*classifier.CALENDAR, *classifier.CATEGORIES, *classifier.MEASURES]
    moments = classifier.feature_moments(flights(spark, sf_dir, *columns))
    return moments.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def ml_rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of a known predictor: late departure means late arrival."""
    rows = normalise.required(flights(spark, sf_dir, "DEP_DELAY", "IS_DELAY"), ["IS_DELAY"])
    scored = rows.select("IS_DELAY", (F.col("DEP_DELAY") > 0).cast("double").alias("prediction"))
    measured = classifier.metrics(classifier.confusion(scored, "IS_DELAY"))
    return measured.select("test_rows", *[F.round(c, 9).alias(c) for c in ("accuracy", "f1")])


def ml_scaled_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [*classifier.CALENDAR, *classifier.CATEGORIES, *classifier.MEASURES]
    moments = classifier.feature_moments(flights(spark, sf_dir, *columns), "FEATURES")
    return moments.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def _measured(task: classifier.Task, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A classifier fitted, saved, loaded and measured: the sizes of its parts and classes.

    What it predicts is the library's affair; ``measured_rows`` are the rows its confusion matrix holds.
    """
    rows = flights(spark, sf_dir, *dict.fromkeys([*SCAN_IDENTITY, *task.columns]))
    found = classifier.fit_and_measure(rows, task, work_folder(spark, "model"), SCAN_IDENTITY, portable=True)[1]
    cells = F.expr("true_negatives + false_positives + false_negatives + true_positives")
    return found.select(
        "label", "train_rows", "train_negatives", "train_positives", "test_rows", cells.alias("measured_rows")
    )


def _separable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows of a label that one feature parts with a wide margin, scored by a saved model."""
    task = classifier.Task("FAR", ("DISTANCE",), fraction=1.0, max_iter=50, reg_param=0.0001)
    columns = [*SCAN_IDENTITY, *classifier.CALENDAR, *classifier.CATEGORIES, *classifier.MEASURES]
    rows = flights(spark, sf_dir, *columns).filter("DISTANCE < 800 OR DISTANCE > 1700")
    rows = rows.withColumn("FAR", (F.col("DISTANCE") > 1250).cast("int"))
    return classifier.fit_and_measure(rows, task, work_folder(spark, "model"), SCAN_IDENTITY, portable=True)[2]


def ml_separable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The confusion matrix of a label that one feature parts with a wide margin."""
    return classifier.confusion(_separable(spark, sf_dir), "FAR")


def ml_score_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score column beside label and prediction: whether the larger score is that of the predicted class."""
    shown = classifier.score_columns(_separable(spark, sf_dir), "FAR")
    scores = vector_to_array(shown.columns[-1])
    agrees = (scores[1] > scores[0]) == (F.col("prediction") == 1)
    kinds = shown.groupBy(F.col("FAR").alias("label"), F.col("prediction").cast("int").alias("prediction"))
    return kinds.agg(F.count("*").alias("n"), F.bool_and(agrees).alias("agrees"))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {name: partial(_result_table, name) for name in catalogue.TABLES}
    found |= {
        "airline_route_summary": airline_route_summary,
        "top_destinations": top_destinations,
        "grain_rollup_all": grain_rollup_all,
        "day_partials": day_partials,
        "normalise_flights": normalise_flights,
        "calendar_parts": calendar_of_dates,
        "delay_flag": delay_flag,
        "dedup_flights": dedup_flights,
        "required_fields": required_fields,
        "csv_roundtrip": csv_roundtrip,
        "csv_inferred_summary": csv_inferred_summary,
        "csv_top_destinations": csv_top_destinations,
        "parquet_roundtrip": parquet_roundtrip,
        "ingest_manifest": ingest_manifest,
        "wire_roundtrip": wire_roundtrip,
        "delay_defaults": delay_defaults,
        "wire_flights": wire_flights,
        "stream_raw_append": stream_raw_append,
        "stream_running_count": stream_running_count,
        "stream_tumbling_count": stream_tumbling_count,
        "stream_late_drop": stream_late_drop,
        "flight_summary_speed": flight_summary_speed,
        "stream_origin_minutes": stream_origin_minutes,
        "delay_runs_carrier": partial(delay_runs, "carrier", False),
        "delay_runs_src_dest": partial(delay_runs, "src_dest", False),
        "delay_runs_year_src_dest": partial(delay_runs, "src_dest", True),
        "change_feed": change_feed,
        "changes_applied": changes_applied,
        "refreshed_partials": refreshed_partials,
        "asof_click": asof_click,
        "asof_previous_order": asof_previous_order,
        "open_items": open_items,
        "open_items_peak": open_items_peak,
        "distinct_sketches": distinct_sketches,
        "quantile_sketches": quantile_sketches,
        "legs_roundtrip": legs_roundtrip,
        "stream_interval": stream_interval,
        "stream_batch_error": stream_batch_error,
        "stream_once": stream_once,
        "stream_once_count": stream_once_count,
        "stream_late_kept": stream_late_kept,
        "stream_closed_corrected": stream_closed_corrected,
        "merged_latest": merged_latest,
        "merged_sums": merged_sums,
        "latest_per_key": latest_per_key,
        "hash_sample": hash_sample,
        "hash_split": hash_split,
        "label_classes": label_classes,
        "ml_string_index": ml_string_index,
        "ml_feature_moments": ml_feature_moments,
        "ml_scaled_moments": ml_scaled_moments,
        "ml_rule_metrics": ml_rule_metrics,
        "ml_delay_metrics": partial(_measured, classifier.DELAY),
        "ml_cancel_metrics": partial(_measured, classifier.CANCELLATION),
        "ml_separable": ml_separable,
        "ml_score_column": ml_score_column,
        "sink_document_ids": sink_document_ids,
        "sink_top_destinations": sink_top_destinations,
        "counts_on_write": counts_on_write,
        "sorted_preview": sorted_preview,
        "kept_columns": kept_columns,
    }
    return found
