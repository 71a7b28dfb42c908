"""Result tables: NULL and empty cases, invariants, brute force, and one pass against separate scans."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from skytally.operators import ranking, rollups, sampling, streaks
from skytally.plans import catalogue, jobs
from skytally.sources.star import flights

SCHEMA = (
    "OP_CARRIER string, ORIGIN string, DEST string, YEAR int, MONTH int, DAYOFWEEK int, FL_DATE date, "
    "DEP_DELAY float, ARR_DELAY float, CANCELLED int, DIVERTED int, CANCELLATION_CODE string, DISTANCE float"
)


def made_up(n=400, seed=1):
    """Small random flights with NULLs everywhere they can be, and one carrier with a third of all rows."""
    pick = random.Random(seed)
    out = []
    for _ in range(n):
        day = dt.date(2023, 12, 20) + dt.timedelta(days=pick.randrange(25))
        cancelled = pick.choice([0, 0, 0, 1, None])
        gone = cancelled == 1
        carrier = "HOT" if pick.random() < 1 / 3 else pick.choice(["A", "B", None])
        out.append((
            carrier, pick.choice(["X", "Y", None]), pick.choice(["X", "Z"]), day.year, day.month, day.isoweekday() % 7 + 1, day,
            None if gone else float(pick.randrange(-20, 20)), None if gone else pick.choice([None, float(pick.randrange(-20, 20))]),
            cancelled, pick.choice([0, 0, 1, None]), pick.choice(["A", "B", "", None]) if gone else None,
            pick.choice([None, 100.0, 250.0]),
        ))
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(made_up(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def partials(table):
    return catalogue.day_partials(table)


def test_twenty_three_tables():
    assert len(catalogue.TABLES) == 23
    assert catalogue.TABLES["dist_total_carrier"].id_columns == ("OP_CARRIER",)
    assert catalogue.TABLES["canc_div_year_month_src_dest"].order == ("YEAR", "MONTH", "ORIGIN", "DEST")
    assert "dist_total_src_dest" not in catalogue.TABLES


@pytest.mark.parametrize("name", sorted(catalogue.TABLES))
def test_one_pass_equals_separate_scan(table, partials, name):
    separate = catalogue.result_table(table, name)
    one_pass = catalogue.result_from_partials(partials, name)
    assert separate.dtypes == one_pass.dtypes
    assert rows(separate) == rows(one_pass)
    assert separate.count() > 0


@pytest.mark.parametrize("name", sorted(catalogue.TABLES))
def test_order_is_presentation_only(table, name):
    in_order = catalogue.result_table(table, name, in_order=True)
    assert rows(in_order) == rows(catalogue.result_table(table, name))
    order = catalogue.TABLES[name].order
    keys = [tuple((v is not None, v) for v in (r[c] for c in order)) for r in in_order.collect()]
    assert keys == sorted(keys)


def test_rates_by_hand(spark):
    frame = spark.createDataFrame(
        [("a", 1, 0), ("a", 0, 1), ("a", None, 0), ("b", 0, 0), ("c", 1, 0), (None, 1, None)], "k string, CANCELLED int, DIVERTED int"
    )
    result = {r.k: r for r in rollups.rate_by(frame, ["k"], catalogue.events()).collect()}
    assert result["a"].asDict() == {
        "k": "a", "CANC_PERC": 1 / 3 * 100.0, "CANC_COUNT": 1, "DIV_PERC": 1 / 3 * 100.0, "DIV_COUNT": 1, "TOTAL_FLIGHTS": 3,
    }
    assert (result["b"].CANC_PERC, result["c"].CANC_PERC, result[None].CANC_PERC) == (0.0, 100.0, 100.0)


def test_mean_of_cancelled_group_is_null(spark):
    frame = spark.createDataFrame([("a", None, None), ("b", 1.0, None), ("b", 2.0, 4.0)], "k string, d float, a float")
    result = rollups.mean_by(frame, ["k"], {"D": "d", "A": "a"})
    assert rows(result) == [("a", None, None), ("b", 1.5, 4.0)]
    assert dict(result.dtypes) == {"k": "string", "D": "double", "A": "double"}


def test_totals_skip_groups_without_distance(spark):
    frame = spark.createDataFrame([("a", None), ("b", 1.0), ("b", None)], "k string, d float")
    assert rows(rollups.total_by(frame, ["k"], {"T": "d"})) == [("b", 1.0)]


def test_invariants(table):
    fine = catalogue.result_table(table, "canc_div_year_month_carrier")
    coarse = catalogue.result_table(table, "canc_div_total_carrier")
    added = fine.groupBy("OP_CARRIER").agg(F.sum("CANC_COUNT").alias("c"), F.sum("TOTAL_FLIGHTS").alias("t"))
    assert rows(added) == rows(coarse.select("OP_CARRIER", "CANC_COUNT", "TOTAL_FLIGHTS"))
    for row in fine.collect():
        assert 0 <= row.CANC_PERC <= 100 and 0 <= row.DIV_PERC <= 100
        assert row.CANC_COUNT <= row.TOTAL_FLIGHTS


def test_null_key_and_left_out_key_stay_apart(table):
    grains = catalogue.all_grains(table)
    carriers = grains.filter("GRAIN = 'carrier_total' AND OP_CARRIER IS NULL")
    assert carriers.count() == 1
    assert carriers.first().TOTAL_FLIGHTS == table.filter("OP_CARRIER IS NULL").count()
    totals = grains.groupBy("GRAIN").agg(F.sum("TOTAL_FLIGHTS").alias("n"))
    assert {r.n for r in totals.collect()} == {table.count()}


# Streaks ---------------------------------------------------------------------


def brute_force(records):
    """Longest run per (carrier, year), by walking the sorted days."""
    days = defaultdict(lambda: defaultdict(list))
    for carrier, year, day, delay in records:
        if delay is not None and day is not None:
            days[carrier, year][day].append(delay)
    out = []
    for (carrier, year), by_day in days.items():
        late = sorted(d for d, v in by_day.items() if sum(v) / len(v) > 0)
        best = run = 0
        for i, day in enumerate(late):
            run = run + 1 if i and (day - late[i - 1]).days == 1 else 1
            best = max(best, run)
        if best:
            out.append((carrier, year, best))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(5))
def test_streaks_equal_brute_force(spark, seed):
    pick = random.Random(seed)
    records = []
    for _ in range(600):
        day = dt.date(2023, 11, 1) + dt.timedelta(days=pick.randrange(120))
        delay = pick.choice([None, 0.0, float(pick.randrange(-9, 12))])
        records.append((pick.choice(["A", "B", None]), day.year, day, delay))
    frame = spark.createDataFrame(records, "OP_CARRIER string, YEAR int, FL_DATE date, ARR_DELAY float")
    result = streaks.longest_delay_run(frame, ["OP_CARRIER", "YEAR"])
    assert rows(result) == brute_force(records)
    assert dict(result.dtypes)["MAX_CONSEC_DELAY_DAYS"] == "int"


def test_streak_edges(spark):
    d = dt.date
    records = [
        ("newyear", d(2023, 12, 30), 5.0), ("newyear", d(2023, 12, 31), 5.0), ("newyear", d(2024, 1, 1), 5.0),
        ("gap", d(2024, 3, 1), 1.0), ("gap", d(2024, 3, 2), 1.0), ("gap", d(2024, 3, 4), 1.0),
        ("zero", d(2024, 3, 1), 2.0), ("zero", d(2024, 3, 2), 4.0), ("zero", d(2024, 3, 2), -4.0), ("zero", d(2024, 3, 3), 1.0),
        ("early", d(2024, 3, 1), -1.0),
        ("leap", d(2024, 2, 28), 1.0), ("leap", d(2024, 2, 29), 1.0), ("leap", d(2024, 3, 1), 1.0),
    ]
    frame = spark.createDataFrame(records, "k string, d date, m float").withColumn("y", F.year("d"))
    result = streaks.longest_delay_run(frame, ["k", "y"], "d", "m", "n")
    assert rows(result) == [("gap", 2024, 2), ("leap", 2024, 3), ("newyear", 2023, 2), ("newyear", 2024, 1), ("zero", 2024, 1)]


def test_streak_plan_moves_days_not_flights(spark, sf_dir):
    source = flights(spark, sf_dir, "OP_CARRIER", "YEAR", "FL_DATE", "ARR_DELAY")
    plan = plan_of(streaks.longest_delay_run(source, ["OP_CARRIER", "YEAR"]))
    top = plan.split("avg(ARR_DELAY")[0]
    assert top.count("Exchange hashpartitioning") == 1
    assert plan.count("Window ") == 1


# Ranking, summary, sampling --------------------------------------------------


def test_top_cut_is_stable(spark):
    values = ["b"] * 2 + ["a"] * 2 + ["c"] * 2 + ["d"] * 3 + [None] * 9
    frame = spark.createDataFrame([(v,) for v in values], "v string").repartition(4)
    top = ranking.top_counts(frame, "v", 2)
    assert [tuple(r) for r in top.collect()] == [("d", 3), ("a", 2)]
    assert ranking.top_counts(frame, "v", 50).count() == 4
    assert "TakeOrderedAndProject" in plan_of(top)


def test_summary_keys(spark):
    frame = spark.createDataFrame(
        [("9E", "A-B", "C", "1", None), ("9E", "A-B", "C", "x", "4"), (None, "A", "C", "1", "1"), ("9E", None, "C", "2", "2")],
        "Reporting_Airline string, OriginCityName string, DestCityName string, ArrDelayMinutes string, DepDelayMinutes string",
    )
    result = jobs.route_summary(frame)
    assert rows(result) == sorted([("9E", "A-B", "C", 1.0, 4.0, 2, "9E-A-B-C"), ("9E", None, "C", 2.0, 2.0, 1, "9E-(none)-C")], key=repr)
    assert result.columns == [
        "Reporting_Airline", "OriginCityName", "DestCityName", "avg_arrival_delay", "avg_departure_delay", "total_flights", "id"
    ]


def test_latest_per_key(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "z"), (None, 1, "n"), ("a", 2, "y")], "k string, t int, v string")
    result = ranking.latest_per_key(frame, ["k"], ["t"])
    assert rows(result) == sorted([("a", 3, None), ("b", 2, "z"), (None, 1, "n")], key=repr)
    assert "Window" not in plan_of(result)


def test_samples(spark):
    frame = spark.range(20_000).selectExpr("id", "string(id % 13) AS t")
    for portable in (False, True):
        assert abs(sampling.bucket_sample(frame, ["id"], 0.2, portable=portable).count() - 4000) < 300
    chosen = sampling.bucket_sample(frame, ["id"], 0.2)
    assert rows(chosen) == rows(sampling.bucket_sample(frame.repartition(7), ["id"], 0.2))
    assert rows(chosen) != rows(sampling.bucket_sample(frame, ["id"], 0.2, salt="other"))
    parts = sampling.bucket_split(frame, ["id"], {"a": 0.5, "b": 0.3, "c": 0.2})
    sizes = {r.PART: r["count"] for r in parts.groupBy("PART").count().collect()}
    assert sum(sizes.values()) == 20_000
    assert abs(sizes["a"] - 10_000) < 400 and abs(sizes["c"] - 4000) < 300
    with pytest.raises(ValueError):
        sampling.bucket_split(frame, ["id"], {"a": 0.5, "b": 0.4})
    assert sampling.random_sample(frame, 0.5, 42).count() == sampling.random_sample(frame, 0.5, 42).count()
    assert sum(p.count() for p in sampling.random_split(frame, [0.8, 0.2], 1234)) == 20_000


def test_preview(table):
    assert ranking.preview(table, 5).count() == 5
