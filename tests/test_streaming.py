"""Messages and streams: parsing rules, replay, late rows, restart, batch equality."""

import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.plans import jobs, queries
from skytally.schemas import RAW_COLUMNS, WIRE_SCHEMA, ZERO_DEFAULT_COLUMNS
from skytally.sinks.tables import batch_folder_writer, latest_view, read_batches
from skytally.sources import messages
from skytally.streaming import control, counts

SMALL = T.StructType().add("name", T.StringType()).add("amount", T.DoubleType())


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def put(folder, name, *records):
    """One file of messages. Files arrive a second apart: the source orders them by modification time."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))
    arrival = 1_700_000_000 + len(list(folder.iterdir()))
    os.utime(folder / name, (arrival, arrival))


# Parsing ---------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, name, amount",
    [
        ('{"name": "a", "amount": 1.5}', "a", 1.5),
        ('{"name": 12, "amount": 2}', "12", 2.0),
        ('{"name": true, "amount": null}', "true", None),
        ('{"name": {"x": 1}, "amount": "7"}', '{"x":1}', None),
        ('{"name": "a", "amount": ""}', "a", None),
        ('{"name": "a", "amount": "soon"}', "a", None),
        ('{"name": "a", "other": 1}', "a", None),
        ("{broken", None, None),
        ("", None, None),
    ],
)
def test_permissive_parsing(spark, text, name, amount):
    (row,) = messages.parse_messages(lines(spark, text), SMALL).collect()
    assert tuple(row) == (name, amount)


def test_unreadable_text_and_unknown_fields_can_be_seen(spark):
    parsed = messages.parse_messages(
        lines(spark, "{broken", '{"name": "a", "extra": 1}'), SMALL, corrupt_column="_bad", unknown_column="_unknown"
    )
    assert rows(parsed) == sorted([(None, None, "{broken", None), ("a", None, None, ["extra"])], key=repr)


def test_other_columns_are_kept(spark):
    parsed = messages.parse_messages(lines(spark, '{"name": "a"}').withColumn("id", F.lit("k")), SMALL)
    assert [tuple(r) for r in parsed.collect()] == [("a", None, "k")]


def test_ids_come_from_position_or_payload(spark):
    kafka = spark.createDataFrame(
        [(bytearray(b"{}"), "t", 0, 5), (bytearray(b"{}"), "t", 0, 6)], "value binary, topic string, partition int, offset bigint"
    )
    assert rows(messages.identified(kafka)) == [("{}", "t:0:5"), ("{}", "t:0:6")]
    ids = [r.id for r in messages.identified(lines(spark, "{}", "{}", "{ }")).collect()]
    assert len(ids[0]) == 64 and ids[0] == ids[1] != ids[2]


def test_microseconds_and_nulls_survive(spark):
    frame = spark.createDataFrame([(dt.datetime(2024, 1, 1, 2, 3, 4, 567891), None)], "t timestamp_ntz, n string")
    written = messages.to_messages(frame)
    assert written.first().value == '{"t":"2024-01-01T02:03:04.567891","n":null}'
    assert rows(messages.parse_messages(written, frame.schema)) == rows(frame)


def raw(spark, **values):
    texts = [values.get(c) for c in RAW_COLUMNS]
    return spark.createDataFrame([texts], T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS]))


def test_typed_messages(spark):
    frame = raw(spark, DepDelay="-5.00", ArrDelay="", CarrierDelay="x", TaxiOut=None, CRSDepTime="0856", Origin=None)
    message = json.loads(messages.to_messages(messages.typed_rows(frame, fill=True)).first().value)
    assert list(message) == RAW_COLUMNS
    assert (message["DepDelay"], message["ArrDelay"], message["CarrierDelay"]) == (-5.0, 0.0, None)
    assert (message["TaxiOut"], message["CRSDepTime"], message["Origin"]) == (None, "0856", "")
    assert all(message[c] == 0.0 for c in ZERO_DEFAULT_COLUMNS if c not in ("DepDelay", "CarrierDelay"))


def test_messages_keep_empty_fields_empty(spark):
    frame = raw(spark, CRSDepTime="0856", DepDelay="-5.00", ArrDelay="")
    message = json.loads(messages.to_messages(messages.typed_rows(frame)).first().value)
    assert list(message) == RAW_COLUMNS
    assert (message["CRSDepTime"], message["DepDelay"]) == ("0856", -5.0)
    assert message["ArrDelay"] is None and message["Origin"] is None


def test_published_messages_parse_to_their_rows(spark):
    """What is sent under the wire schema is read back under it."""
    frame = messages.typed_rows(raw(spark, Year="2024", CRSDepTime="0856", DepDelay="-5.00", OriginCityName="Omaha, NE"))
    assert frame.schema == WIRE_SCHEMA
    assert rows(messages.parse_messages(messages.to_messages(frame))) == rows(frame)


# Streams ---------------------------------------------------------------------


def read_in(spark, folder, schema=SMALL, **options):
    return messages.parse_messages(messages.message_stream(spark, "text", options, str(folder)), schema)


def test_running_count_over_batches(spark, tmp_path):
    wave = [["a", "b", "a", None], ["a", "c"], ["b", None, "a"]]
    for i, names in enumerate(wave):
        put(tmp_path / "in", f"{i}.json", *[{"name": n} for n in names])
    stream = counts.running_count(read_in(spark, tmp_path / "in", maxFilesPerTrigger="1"), "name", "n")
    query = control.run_available(stream, batch_folder_writer(f"{tmp_path}/out"), f"{tmp_path}/cp", "update")
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    batches = read_batches(spark, f"{tmp_path}/out", stream.schema)
    assert rows(latest_view(batches, ["name"]).select("name", "n")) == sorted(
        [("a", 4), ("b", 2), ("c", 1), (None, 2)], key=repr
    )
    # Update mode writes changed keys only.
    assert rows(batches.filter("batch_id = 1").select("name", "n")) == [("a", 3), ("c", 1)]


def test_state_partitions_belong_to_the_query(spark, tmp_path):
    put(tmp_path / "in", "0.json", {"name": "a"})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stream = counts.running_count(read_in(spark, tmp_path / "in"), "name", "n")
    query = control.run_available(stream, batch_folder_writer(f"{tmp_path}/out"), f"{tmp_path}/cp", "update", 3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before != "3"
    assert {s.numShufflePartitions for p in query.recentProgress for s in p.stateOperators} == {3}


def test_restart_takes_up_where_it_ended(spark, tmp_path):
    for i, names in enumerate((["a", "b"], ["a"])):
        put(tmp_path / "in", f"{i}.json", *[{"name": n} for n in names])
        stream = counts.running_count(read_in(spark, tmp_path / "in"), "name", "n")
        control.run_available(stream, batch_folder_writer(f"{tmp_path}/out"), f"{tmp_path}/cp", "update")
    view = latest_view(read_batches(spark, f"{tmp_path}/out", stream.schema), ["name"])
    assert rows(view.select("name", "n")) == [("a", 2), ("b", 1)]


def test_replayed_batch_leaves_no_copies(spark, tmp_path):
    put(tmp_path / "in", "0.json", {"name": "a", "amount": 1}, {"name": "b", "amount": 2})
    write = batch_folder_writer(f"{tmp_path}/out")
    failing = {"left": 1}

    def write_then_fail(batch, batch_id):
        write(batch, batch_id)
        if failing["left"]:
            failing["left"] -= 1
            raise RuntimeError("lost after writing")

    with pytest.raises(StreamingQueryException):
        control.run_available(read_in(spark, tmp_path / "in"), write_then_fail, f"{tmp_path}/cp")
    first = rows(spark.read.parquet(f"{tmp_path}/out"))
    control.run_available(read_in(spark, tmp_path / "in"), write_then_fail, f"{tmp_path}/cp")
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == first and len(first) == 2


def test_windows_watermark_and_late_rows(spark, tmp_path):
    schema = T.StructType().add("t", T.TimestampNTZType()).add("name", T.StringType())
    waves = [
        ["2024-01-01T00:00:10.000000", "2024-01-01T00:00:50.000000", "2024-01-01T00:01:00.000000"],
        ["2024-01-01T00:10:00.000000"],
        ["2024-01-01T00:00:30.000000", "2024-01-01T00:09:30.000000"],
        ["2024-01-01T01:00:00.000000"],
    ]
    for i, wave in enumerate(waves):
        put(tmp_path / "in", f"{i}.json", *[{"t": t, "name": "a"} for t in wave])
        stream = counts.tumbling_count(read_in(spark, tmp_path / "in", schema), "t", "name", "1 minute", "2 minutes", "n")
        query = control.run_available(stream, batch_folder_writer(f"{tmp_path}/out"), f"{tmp_path}/cp", "append")
        if i == 2:
            assert sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators) == 1
    found = read_batches(spark, f"{tmp_path}/out", stream.schema)
    starts = [(str(r.s), r.n) for r in found.select(F.col("window_start").cast("timestamp_ntz").alias("s"), "n").orderBy("s").collect()]
    # 00:00:30 came too late, 00:09:30 in time; the window of 01:00 is still open.
    assert starts == [
        ("2024-01-01 00:00:00", 2), ("2024-01-01 00:01:00", 1), ("2024-01-01 00:09:00", 1), ("2024-01-01 00:10:00", 1)
    ]


def test_failure_is_raised_and_stops(spark, tmp_path):
    put(tmp_path / "in", "0.json", {"name": "a"})

    def broken(batch, batch_id):
        raise RuntimeError("no sink")

    query = control.start(read_in(spark, tmp_path / "in"), broken, f"{tmp_path}/cp", interval="1 second")
    with pytest.raises(StreamingQueryException, match="no sink"):
        control.await_end(query, 60)
    assert not query.isActive


def test_await_stops_after_the_timeout(spark, tmp_path):
    put(tmp_path / "in", "0.json", {"name": "a"})
    query = control.start(
        read_in(spark, tmp_path / "in"), batch_folder_writer(f"{tmp_path}/out"), f"{tmp_path}/cp", interval="1 second"
    )
    assert control.await_end(query, 3) is False
    assert not query.isActive


def test_one_failure_stops_all(spark, tmp_path):
    put(tmp_path / "in", "0.json", {"name": "a"})

    def broken(batch, batch_id):
        raise RuntimeError("no sink")

    stream = read_in(spark, tmp_path / "in")
    good = control.start(stream, batch_folder_writer(f"{tmp_path}/out"), f"{tmp_path}/cp1", interval="1 second")
    bad = control.start(stream, broken, f"{tmp_path}/cp2", interval="1 second")
    with pytest.raises(StreamingQueryException, match="no sink"):
        control.await_any([good, bad], 60)
    assert not good.isActive and not bad.isActive


def test_speed_layer(spark, tmp_path):
    cities = ["Omaha, NE", "Omaha, NE", "New York, NY"]
    put(tmp_path / "in", "0.json", *[{"OriginCityName": c, "CRSDepTime": "0856", "ArrDelay": -1.5} for c in cities], "{broken")
    stream = messages.message_stream(spark, "text", path=str(tmp_path / "in"))
    for query in jobs.speed_layer(stream, *jobs.folder_writers(f"{tmp_path}/out"), f"{tmp_path}/cp", interval=None):
        control.await_end(query)
    raw_rows = spark.read.parquet(f"{tmp_path}/out/raw")
    assert raw_rows.count() == 4
    assert set(WIRE_SCHEMA.names) | {"id", "batch_id"} == set(raw_rows.columns)
    assert raw_rows.filter("OriginCityName IS NULL AND id IS NOT NULL").count() == 1
    view = latest_view(spark.read.parquet(f"{tmp_path}/out/by_origin"), ["OriginCityName"])
    assert rows(view.select("OriginCityName", "recent_flight_count", "id")) == sorted(
        [("Omaha, NE", 2, "Omaha, NE"), ("New York, NY", 1, "New York, NY"), (None, 1, "(none)")], key=repr
    )


@pytest.mark.parametrize("name", ["stream_running_count", "stream_tumbling_count", "flight_summary_speed", "stream_origin_minutes"])
def test_counts_do_not_depend_on_batches(spark, sf_dir, name):
    """Ten micro-batches or more, as many as there are files, and a single one give the same rows."""
    query = getattr(queries, name)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        assert rows(query(spark, sf_dir, 1)) == rows(query(spark, sf_dir, 10_000))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_windows_of_moments_without_zone(spark, tmp_path, zone):
    """The hours around a change of clocks stay apart."""
    schema = T.StructType().add("t", T.TimestampNTZType()).add("name", T.StringType())
    moments = [f"2024-10-27T0{h}:30:00.000000" for h in range(5)] + [f"2024-03-31T0{h}:30:00.000000" for h in range(5)]
    put(tmp_path / "in", "0.json", *[{"t": t, "name": "a"} for t in moments])
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stream = counts.tumbling_count(read_in(spark, tmp_path / "in", schema), "t", "name", "1 hour", "400 days", "n")
        control.run_available(stream, batch_folder_writer(f"{tmp_path}/out"), f"{tmp_path}/cp", "update")
        found = sorted((str(r.window_start), r.n) for r in read_batches(spark, f"{tmp_path}/out", stream.schema).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == sorted((t[:13].replace("T", " ") + ":00:00", 1) for t in moments)


def test_windows_of_the_speed_layer_and_compaction(spark, tmp_path):
    flight = {"OriginCityName": "Omaha, NE", "FlightDate": "2024-01-08", "CRSDepTime": "0856"}
    put(tmp_path / "in", "0.json", flight, flight, flight | {"CRSDepTime": ""})
    stream = messages.message_stream(spark, "text", path=str(tmp_path / "in"))
    out = f"{tmp_path}/out"
    writers = (*jobs.folder_writers(out), f"{tmp_path}/cp", None, 2, batch_folder_writer(f"{out}/by_minute"))
    for query in jobs.speed_layer(stream, *writers):
        control.await_end(query)
    (window,) = spark.read.parquet(f"{out}/by_minute").collect()
    assert (str(window.window_start), window.n) == ("2024-01-08 08:56:00", 2)
    put(tmp_path / "in", "1.json", flight)
    for query in jobs.speed_layer(stream, *writers):
        control.await_end(query)
    batches = spark.read.parquet(f"{out}/by_origin")
    jobs.compact(spark, f"{out}/by_origin", f"{tmp_path}/current", ["OriginCityName"])
    current = spark.read.parquet(f"{tmp_path}/current")
    assert rows(current) == rows(latest_view(batches, ["OriginCityName"]).select(*current.columns))
    assert batches.count() == 2 and [r.recent_flight_count for r in current.collect()] == [4]


def test_no_batches_give_no_rows(spark, tmp_path):
    empty = read_batches(spark, f"{tmp_path}/none", SMALL)
    assert empty.count() == 0 and empty.columns == ["name", "amount", "batch_id"]
