"""Messages sent again, late rows, and tables that take up micro-batches bucket by bucket."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_streaming import put

from skytally.plans import jobs
from skytally.sinks import files, merged
from skytally.sinks.tables import batch_folder_writer, latest_view, read_batches
from skytally.sources import messages
from skytally.streaming import control, late
from skytally.streaming.once import once_within

TIMED = T.StructType().add("t", T.TimestampNTZType()).add("name", T.StringType())


def at(minute, name="a"):
    return {"t": None if minute is None else f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00.000000", "name": name}


def timed_stream(spark, folder):
    return messages.parse_messages(messages.message_stream(spark, "text", {"maxFilesPerTrigger": "1"}, str(folder)), TIMED)


# Messages sent again ---------------------------------------------------------


def test_copies_go_and_state_shrinks(spark, tmp_path):
    """Five micro-batches of ten keys, the copies in the same batch, the next and the one after. Old keys leave the state."""
    for batch in range(5):
        own = [at(60 * batch + i, f"k{batch}-{i}") for i in range(10)]
        before = [at(60 * b + i, f"k{b}-{i}") for b in (batch - 1, batch - 2) if b >= 0 for i in range(0, 10, 3)]
        put(tmp_path / "in", f"{batch}.json", *own, *own[::2], *before)
    # Then nothing but one key, far ahead: the watermark passes all others.
    put(tmp_path / "in", "8.json", at(23 * 60, "last"))
    put(tmp_path / "in", "9.json", at(23 * 60, "last"))
    stream = once_within(timed_stream(spark, tmp_path / "in"), "name", "t", "3 hours")
    query = control.run_available(stream, batch_folder_writer(f"{tmp_path}/out"), f"{tmp_path}/cp")
    found = [r.name for r in read_batches(spark, f"{tmp_path}/out", stream.schema).collect()]
    assert sorted(found) == sorted([f"k{b}-{i}" for b in range(5) for i in range(10)] + ["last"])
    held = [s.numRowsTotal for p in query.recentProgress for s in p.stateOperators]
    assert max(held) == 51 and held[-1] == 1


def test_messages_without_moment_or_key_are_not_lost(spark, tmp_path):
    for i in range(3):
        put(tmp_path / "in", f"{i}.json", at(None, "undated"), at(i, None), at(60 * i, "a"))
    stream = once_within(timed_stream(spark, tmp_path / "in"), "name", "t", "1 day")
    control.run_available(stream, batch_folder_writer(f"{tmp_path}/out"), f"{tmp_path}/cp")
    found = [r.name for r in read_batches(spark, f"{tmp_path}/out", stream.schema).collect()]
    assert found.count("a") == 1 == found.count(None) and 1 <= found.count("undated") <= 3


@pytest.mark.parametrize("together", [True, False])
def test_speed_layer_counts_once(spark, tmp_path, together):
    flight = {"OriginCityName": "Omaha, NE", "FlightDate": "2024-01-08", "CRSDepTime": "0856"}
    other = flight | {"CRSDepTime": "0900"}
    waves = [[flight, flight, other], [other, flight], [flight | {"OriginCityName": "Waco, TX"}]]
    for i, wave in enumerate([sum(waves, [])] if together else waves):
        put(tmp_path / "in", f"{i}.json", *wave)
        stream = messages.message_stream(spark, "text", path=str(tmp_path / "in"))
        query, once = jobs.without_redeliveries(spark, stream, f"{tmp_path}/once", f"{tmp_path}/cp_once", interval=None)
        control.await_end(query)
        writers = (*jobs.folder_writers(f"{tmp_path}/out"), f"{tmp_path}/cp", None, 2, None, "1 hour", f"{tmp_path}/late")
        for query in jobs.speed_layer(once, *writers):
            control.await_end(query)
    raw = spark.read.parquet(f"{tmp_path}/out/raw")
    assert raw.count() == 3 == raw.select("id").distinct().count()
    view = latest_view(spark.read.parquet(f"{tmp_path}/out/by_origin"), ["OriginCityName"])
    assert rows(view.select("OriginCityName", "recent_flight_count")) == [("Omaha, NE", 2), ("Waco, TX", 1)]
    city = T.StructType().add("OriginCityName", T.StringType())
    minutes = late.counts_with_late(late.read_partials(spark, f"{tmp_path}/late", city), ["OriginCityName"])
    assert sum(r.n for r in minutes.collect()) == 3


# Late rows -------------------------------------------------------------------

# Minutes; None: no moment. The fourth wave is behind all windows that the second has closed.
WAVES = [[0, 1, 30, None], [150, 151], [100, 149], [5, 6, 29, 31, 95, None], [400], [399, 150, 0]]
NAME = T.StructType().add("name", T.StringType())


def expected():
    found = {}
    for minute in sum(WAVES, []):
        start = None if minute is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute // 30 * 30)
        found[start] = found.get(start, 0) + 1
    return found


def late_writer(path):
    return late.late_counts_writer(f"{path}/out", "t", ["name"], "30 minutes", "1 hour")


def summed(spark, path):
    counted = late.counts_with_late(late.read_partials(spark, f"{path}/out", NAME), ["name"])
    return {r.window_start: (r.n, r.on_time, r.late) for r in counted.collect()}


@pytest.mark.parametrize("per_batch", [1, 2, 6])
def test_no_row_is_lost_whatever_the_batches(spark, tmp_path, per_batch):
    for i in range(0, len(WAVES), per_batch):
        put(tmp_path / "in", f"{i}.json", *[at(m) for m in sum(WAVES[i : i + per_batch], [])])
    control.run_available(timed_stream(spark, tmp_path / "in"), late_writer(tmp_path), f"{tmp_path}/cp")
    found = summed(spark, tmp_path)
    assert {start: n for start, (n, _, _) in found.items()} == expected()
    assert all(n == in_time + behind for n, in_time, behind in found.values())
    assert sum(behind for _, _, behind in found.values()) == {1: 6, 2: 5, 6: 0}[per_batch]


def test_closed_windows_stay_and_corrections_complete_them(spark, tmp_path):
    """After each batch: no closed window has changed; with the corrections so far it has all rows so far."""
    taken = {}
    for i, wave in enumerate(WAVES):
        put(tmp_path / "in", f"{i}.json", *[at(m) for m in wave])
        control.run_available(timed_stream(spark, tmp_path / "in"), late_writer(tmp_path), f"{tmp_path}/cp")
        partials = late.read_partials(spark, f"{tmp_path}/out", NAME)
        closed = late.closed_windows(partials, late.closed_by(spark, f"{tmp_path}/out"), ["name"])
        now = {r.window_start: r.n for r in closed.collect()}
        assert taken.items() <= now.items()
        taken = now
    assert len(taken) >= 4 and None not in taken
    more = {}
    for r in late.corrections(partials, ["name"]).collect():
        more.setdefault(r.window_start, []).append((r.batch_id, r.n))
    assert {b for own in more.values() for b, _ in own} == {3, 5}
    everything = expected()
    for start in taken.keys() | more.keys():
        assert taken.get(start, 0) + sum(n for _, n in more.get(start, [])) == everything[start]


def test_failed_batch_is_counted_once(spark, tmp_path):
    for i, wave in enumerate(WAVES):
        put(tmp_path / "in", f"{i}.json", *[at(m) for m in wave])
    write, failing = late_writer(tmp_path), {1, 3}

    def write_then_fail(batch, batch_id):
        write(batch, batch_id)
        if batch_id in failing:
            failing.remove(batch_id)
            raise RuntimeError("lost after writing")

    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            control.run_available(timed_stream(spark, tmp_path / "in"), write_then_fail, f"{tmp_path}/cp")
    control.run_available(timed_stream(spark, tmp_path / "in"), write_then_fail, f"{tmp_path}/cp")
    found = summed(spark, tmp_path)
    assert {start: n for start, (n, _, _) in found.items()} == expected()
    assert sum(behind for _, _, behind in found.values()) == 6


# Tables in buckets -----------------------------------------------------------


def write_batch(spark, folder, number, values, columns="k string, v int"):
    batch_folder_writer(str(folder))(spark.createDataFrame(values, columns), number)


def all_files(folder):
    return {p.relative_to(folder): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_batches_are_taken_up_bucket_by_bucket(spark, tmp_path):
    source, table = tmp_path / "batches", tmp_path / "table"
    keys = [f"k{i}" for i in range(200)] + [None]
    write_batch(spark, source, 0, [(k, 0) for k in keys])
    assert merged.merge_batches(spark, str(source), str(table), ["k"], buckets=8) == list(range(8))
    before, first = all_files(table), merged.last_commit(spark, str(table))
    write_batch(spark, source, 1, [("k5", 1), ("new", 1)])
    touched = merged.merge_batches(spark, str(source), str(table), ["k"])
    assert 1 <= len(touched) <= 2
    # Files of buckets that the batch does not touch are the same, and still the ones that are read.
    assert before.items() <= all_files(table).items()
    commit = merged.last_commit(spark, str(table))
    assert (commit.upto, commit.version, commit.buckets) == (1, 2, 8)
    assert {b for b in commit.folders if commit.folders[b] != first.folders.get(b)} == {str(b) for b in touched}
    batches = read_batches(spark, str(source), T.StructType().add("k", T.StringType()).add("v", T.IntegerType()))
    assert rows(merged.read_merged(spark, str(table))) == rows(latest_view(batches, ["k"]))
    assert merged.merge_batches(spark, str(source), str(table), ["k"]) == []
    with pytest.raises(ValueError, match="keys"):
        write_batch(spark, source, 2, [("k5", 1)])
        merged.merge_batches(spark, str(source), str(table), ["v"])


def test_only_touched_buckets_are_read(spark, tmp_path):
    source, table = str(tmp_path / "batches"), str(tmp_path / "table")
    write_batch(spark, source, 0, [(f"k{i}", 0) for i in range(100)])
    merged.merge_batches(spark, source, table, ["k"], buckets=8)
    commit = merged.last_commit(spark, table)
    some = merged._rows(spark, table, commit, [3, 5])
    assert {f"{merged.BUCKET}={b}" for b in (3, 5)} == {f.split("/")[-2] for f in some.inputFiles()}


def test_death_before_the_commit_loses_nothing(spark, tmp_path, monkeypatch):
    source, table = str(tmp_path / "batches"), str(tmp_path / "table")
    write_batch(spark, source, 0, [("a", 1), ("b", 1)])
    merged.merge_batches(spark, source, table, ["k"], merged.summed(["k"], ["v"]), 4)
    write_batch(spark, source, 1, [("a", 10), ("c", 10)])

    def dies(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(merged, "write_new", dies)
    with pytest.raises(RuntimeError):
        merged.merge_batches(spark, source, table, ["k"], merged.summed(["k"], ["v"]))
    assert rows(merged.read_merged(spark, table)) == [("a", 1), ("b", 1)]
    monkeypatch.undo()
    merged.merge_batches(spark, source, table, ["k"], merged.summed(["k"], ["v"]))
    assert rows(merged.read_merged(spark, table)) == [("a", 11), ("b", 1), ("c", 10)]
    # What the killed job has left goes, with what no commit names any more.
    assert merged.remove_old(spark, table, keep=1) >= 2
    assert rows(merged.read_merged(spark, table)) == [("a", 11), ("b", 1), ("c", 10)]
    assert len(files.children(spark, f"{table}/commits")) == 1


def test_two_commits_of_one_version_cannot_both_succeed(spark, tmp_path):
    files.write_new(spark, f"{tmp_path}/commits/1.json", "{}")
    with pytest.raises(FileExistsError):
        files.write_new(spark, f"{tmp_path}/commits/1.json", "[]")
    assert files.read_text(spark, f"{tmp_path}/commits/1.json") == "{}"
    assert files.children(spark, f"{tmp_path}/commits") == ["1.json"] and files.children(spark, f"{tmp_path}/none") == []


def test_unfinished_batches_wait_and_columns_may_come(spark, tmp_path):
    source, table = tmp_path / "batches", str(tmp_path / "table")
    for number in range(3):
        write_batch(spark, source, number, [("a", number)])
    (source / "batch_id=1" / "_SUCCESS").unlink()
    merged.merge_batches(spark, str(source), table, ["k"], buckets=2)
    assert merged.last_commit(spark, table).upto == 0
    write_batch(spark, source, 1, [("a", 7, "x"), ("b", 8, "y")], "k string, v int, w string")
    merged.merge_batches(spark, str(source), table, ["k"])
    assert rows(merged.read_merged(spark, table)) == sorted([("a", 2, None), ("b", 8, "y")], key=repr)


def test_nothing_taken_up_yet(spark, tmp_path):
    assert merged.merge_batches(spark, f"{tmp_path}/none", f"{tmp_path}/table", ["k"]) == []
    with pytest.raises(ValueError, match="nothing"):
        merged.read_merged(spark, f"{tmp_path}/table")


def test_merge_job(spark, tmp_path):
    source, table = str(tmp_path / "batches"), str(tmp_path / "table")
    for number in range(4):
        write_batch(spark, source, number, [("a", 1), ("b", number)])
        jobs.merge(spark, source, table, ["k"], 4, ["v"])
    assert rows(merged.read_merged(spark, table)) == [("a", 4), ("b", 6)]
    assert len(files.children(spark, f"{table}/commits")) == 2
    assert merged.read_merged(spark, table).filter(F.col("k") == "a").count() == 1
