"""Text files to the published table: hand-made edge rows."""

import datetime as dt

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from skytally.functions.calendar import calendar_parts, clock_timestamp, day_number
from skytally.functions.conversion import as_date, as_flag, as_float
from skytally.functions.keys import joined_id, portable_hash, safe_id, value_hash
from skytally.operators import normalise
from skytally.schemas import CLOCK_COLUMNS, PROCESSED_SCHEMA, RAW_COLUMNS, WIRE_SCHEMA
from skytally.sinks.tables import counted, write_published
from skytally.sources import tables

BASE = {
    "Year": "2024", "DayOfWeek": "1", "FlightDate": "2024-01-08", "Reporting_Airline": '"9E"',
    "IATA_CODE_Reporting_Airline": '"9E"', "Tail_Number": '"N1"', "Flight_Number_Reporting_Airline": '"4801"',
    "Origin": '"LGA"', "OriginCityName": '"New York, NY"', "Dest": '"OMA"', "DestCityName": '"Omaha, NE"',
    "CRSDepTime": '"0856"', "DepTime": '"0851"', "DepDelay": "-5.00", "DepDelayMinutes": "0.00", "ArrDelay": "-11.00",
    "ArrDelayMinutes": "0.00", "Cancelled": "0.00", "CancellationCode": '""', "Diverted": "0.00", "Distance": "1148.00",
}


def write_csv(path, *changes, columns=RAW_COLUMNS):
    lines = [",".join(f'"{c}"' for c in columns) + ","]
    for change in changes:
        row = BASE | change
        lines.append(",".join(row.get(c, "") for c in columns) + ",")
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_schemas():
    assert len(RAW_COLUMNS) == len(set(RAW_COLUMNS)) == 109
    assert len(PROCESSED_SCHEMA) == 40
    assert WIRE_SCHEMA.names == RAW_COLUMNS
    assert set(CLOCK_COLUMNS) <= set(RAW_COLUMNS)


def test_published_row(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", {})
    (row,) = normalise.normalise(tables.read_raw_csv(spark, path)).collect()
    assert row.FL_DATE == dt.date(2024, 1, 8)
    assert (row.OriginCityName, row.CRSDepTime, row.DepTime) == ("New York, NY", "0856", "0851")
    assert (row.DEP_DELAY, row.ARR_DELAY, row.DISTANCE) == (-5.0, -11.0, 1148.0)
    assert (row.CANCELLED, row.DIVERTED, row.IS_DELAY) == (0, 0, 0)
    assert (row.YEAR, row.MONTH, row.DAYOFMONTH, row.DAYOFWEEK) == (2024, 1, 8, 2)
    assert row.CANCELLATION_CODE is None
    assert row.CARRIER_DELAY is None


def test_published_schema(spark, tmp_path):
    result = normalise.normalise(tables.read_raw_csv(spark, write_csv(tmp_path / "a.csv", {})))
    assert [(f.name, f.dataType) for f in result.schema] == [(f.name, f.dataType) for f in PROCESSED_SCHEMA]


@pytest.mark.parametrize("date", ["", '""', "2024-13-01", "2024-02-30", "soon", "08/01/2024"])
def test_rows_without_a_date_are_dropped(spark, tmp_path, date):
    path = write_csv(tmp_path / "a.csv", {"FlightDate": date}, {})
    assert normalise.normalise(tables.read_raw_csv(spark, path)).count() == 1


def test_bad_numbers_are_null(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", {"ArrDelay": "late", "Cancelled": "yes", "Distance": '""', "DepDelay": ""})
    (row,) = normalise.normalise(tables.read_raw_csv(spark, path)).collect()
    assert (row.ARR_DELAY, row.IS_DELAY, row.CANCELLED, row.DISTANCE, row.DEP_DELAY) == (None,) * 5


def test_copies_are_judged_on_published_columns(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", {}, {}, {"Tail_Number": '"N2"'}, {"DepDelay": "-6.00"})
    assert normalise.normalise(tables.read_raw_csv(spark, path)).count() == 2


def test_columns_by_position_and_by_name(spark, tmp_path):
    turned = list(reversed(RAW_COLUMNS))
    turned.remove("Div5TailNum")
    path = write_csv(tmp_path / "a.csv", {}, columns=turned)
    by_name = tables.read_raw_csv(spark, path, by_name=True)
    assert by_name.columns == RAW_COLUMNS
    (row,) = by_name.collect()
    assert (row.Origin, row.Div5TailNum) == ("LGA", None)
    with pytest.raises(Exception, match="a.csv"):
        tables.read_raw_csv(spark, path).select("Origin", "Dest").collect()


@pytest.mark.parametrize("by_name", [False, True])
def test_a_file_with_another_header_is_refused(spark, tmp_path, by_name):
    swapped = list(RAW_COLUMNS)
    a, b = swapped.index("Origin"), swapped.index("Dest")
    swapped[a], swapped[b] = "Dest", "Origin"
    write_csv(tmp_path / "1.csv", {})
    write_csv(tmp_path / "2.csv", {}, columns=swapped)
    with pytest.raises(Exception, match="[12].csv"):
        tables.read_raw_csv(spark, str(tmp_path), by_name).select("Origin").collect()


def test_folder_list_and_glob(spark, tmp_path):
    for month in ("01", "02"):
        write_csv(tmp_path / f"2023_{month}.csv", {})
    write_csv(tmp_path / "2024_01.csv", {})
    assert tables.read_raw_csv(spark, str(tmp_path)).count() == 3
    assert tables.read_raw_csv(spark, f"{tmp_path}/2023_*.csv").count() == 2
    assert tables.read_raw_csv(spark, [f"{tmp_path}/2023_01.csv", f"{tmp_path}/2024_01.csv"]).count() == 2


def test_inference_keeps_clock_text(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", {}, {"DepDelay": "3.00"})
    inferred = tables.read_inferred_csv(spark, path)
    assert dict(inferred.dtypes)["DepDelay"] == "double"
    assert {r.CRSDepTime for r in inferred.collect()} == {"0856"}


def test_scan_reads_published_columns_only(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", {})
    plan = plan_of(normalise.normalise(tables.read_raw_csv(spark, path)))
    assert "Div1Airport" not in plan and "Tail_Number" not in plan
    observed, _ = counted(normalise.project_published(tables.read_raw_csv(spark, path)), "read")
    assert "Div1Airport" not in plan_of(normalise.clean(observed))


def test_listing(spark, tmp_path):
    write_csv(tmp_path / "a.csv", {})
    (tmp_path / "sub").mkdir()
    write_csv(tmp_path / "sub" / "b.csv", {}, {})
    listed = tables.list_files(spark, str(tmp_path), "*.csv")
    assert {r.file_name: r.bytes for r in listed.collect()} == {
        p.name: p.stat().st_size for p in tmp_path.rglob("*.csv")
    }
    assert tables.list_files(spark, f"{tmp_path}/absent").count() == 0
    scan = spark.read.option("recursiveFileLookup", True).option("header", True).csv(str(tmp_path))
    found = tables.rows_per_file(tables.list_files(spark, str(tmp_path), "*.csv"), scan)
    assert rows(found.select("file_name", "row_count")) == [("a.csv", 1), ("b.csv", 2)]
    assert tables.total_bytes(scan) == sum(p.stat().st_size for p in tmp_path.rglob("*.csv"))


def test_manifest_of_a_partitioned_table(spark, tmp_path):
    """One task writes the same file name into every folder, and names may need escapes."""
    table = spark.range(1000).selectExpr("id", "concat('k +%', id % 10) AS k").repartition(2)
    table.write.partitionBy("k").parquet(f"{tmp_path}/t")
    spark.range(0).write.parquet(f"{tmp_path}/t/k=none")
    files = tables.list_files(spark, f"{tmp_path}/t", "*.parquet")
    found = tables.rows_per_file(files, spark.read.schema("id long").parquet(f"{tmp_path}/t/*"))
    assert found.count() == files.count() > 10 and found.filter("row_count = 0").count() == 1
    assert found.agg(F.sum("row_count")).first()[0] == 1000


def test_written_table_prunes_months(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", {}, {"FlightDate": "2024-02-29"}, {"FlightDate": "2023-12-31"})
    target = str(tmp_path / "out")
    write_published(normalise.normalise(tables.read_raw_csv(spark, path)), target)
    table = tables.read_published(spark, target)
    assert table.columns == PROCESSED_SCHEMA.names
    assert table.count() == 3
    february = table.filter((F.col("YEAR") == 2024) & (F.col("MONTH") == 2))
    assert "PartitionFilters: [isnotnull(YEAR" in plan_of(february)
    assert [r.DAYOFMONTH for r in february.collect()] == [29]
    # A second write replaces the first.
    write_published(normalise.normalise(tables.read_raw_csv(spark, path)).filter("YEAR = 2023"), target)
    assert tables.read_published(spark, target).count() == 1


def test_calendar(spark):
    days = ["2024-01-07", "2024-01-08", "2024-02-29", "2023-12-31", "2024-01-01"]
    frame = spark.createDataFrame([(d,) for d in days], "d string").withColumn("d", as_date(F.col("d")))
    parts = frame.select("d", *[p.alias(n) for n, p in calendar_parts(F.col("d")).items()], day_number(F.col("d")).alias("n"))
    for row in parts.collect():
        assert (row.YEAR, row.MONTH, row.DAYOFMONTH) == (row.d.year, row.d.month, row.d.day)
        assert row.DAYOFWEEK == row.d.isoweekday() % 7 + 1
        assert row.n == (row.d - dt.date(1970, 1, 1)).days


def test_clock(spark):
    cases = [("2024-01-08", "0856"), ("2024-01-08", "5"), ("2024-12-31", "2400"), ("2024-01-08", "2561"), (None, "0856"), ("2024-01-08", None)]
    cases += [("2024-01-08", c) for c in ("", " ", "23599", "12345", "8:56", "-856", "085a")] + [("2024-02-30", "0856"), ("x", "0856")]
    frame = spark.createDataFrame(cases, "d string, c string")
    found = [r[0] for r in frame.select(clock_timestamp(F.col("d"), F.col("c"))).collect()]
    moment = dt.datetime
    assert found == [moment(2024, 1, 8, 8, 56), moment(2024, 1, 8, 0, 5), moment(2025, 1, 1)] + [None] * (len(cases) - 3)


def test_flags_and_floats(spark):
    frame = spark.createDataFrame([("0.00",), ("1.00",), ("",), (None,), ("x",)], "t string")
    assert [r[0] for r in frame.select(as_flag(F.col("t"))).collect()] == [0, 1, None, None, None]
    assert [r[0] for r in frame.select(as_float(F.col("t"))).collect()] == [0.0, 1.0, None, None, None]


def test_ids(spark):
    frame = spark.createDataFrame([("a-b", "c"), ("a", "b-c"), (None, "c"), ("null", "c"), ("", "c")], "x string, y string")
    joined = [r[0] for r in frame.select(joined_id(["x", "y"])).collect()]
    assert joined == ["a-b-c", "a-b-c", "(none)-c", "null-c", "-c"]
    safe = [r[0] for r in frame.select(safe_id(["x", "y"])).collect()]
    assert None not in safe and len(set(safe)) == 5


def test_hash_is_the_same_in_any_partitioning(spark):
    frame = spark.range(1000).selectExpr("id", "string(id % 7) AS t")
    for place, low, high in ((portable_hash, 0, 1 << 32), (value_hash, -(1 << 63), 1 << 63)):
        one = frame.coalesce(1).select("id", place(["id", "t"], "s").alias("b"))
        many = frame.repartition(13).select("id", place(["id", "t"], "s").alias("b"))
        assert rows(one) == rows(many)
        assert all(low <= r.b < high for r in one.collect())


def test_numeric_and_required(spark):
    frame = spark.createDataFrame([("1", "a"), ("x", "b"), (None, None)], "n string, k string")
    assert rows(normalise.numeric(frame, ["n"])) == sorted([(1.0, "a"), (None, "b"), (None, None)], key=repr)
    assert rows(normalise.required(frame, ["n", "k"])) == [("1", "a"), ("x", "b")]
