"""Runs of days, as-of joins, open intervals, changes, sketches and groups of columns, against plain versions."""

import datetime as dt
import random
from collections import Counter

import pytest
from conftest import plan_of, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skytally.operators import asof, changes, concurrency, legs, runs, sketches
from skytally.plans import jobs
from skytally.schemas import RAW_COLUMNS

DAY = dt.date(2023, 11, 1)


# Runs ------------------------------------------------------------------------


def longest(days):
    """Length, first and last day of the earliest longest run."""
    best = (0, None, None)
    for day in sorted(days):
        if day - dt.timedelta(1) in days:
            continue
        last = day
        while last + dt.timedelta(1) in days:
            last += dt.timedelta(1)
        n = (last - day).days + 1
        if n > best[0]:
            best = (n, day, last)
    return best


@pytest.fixture(scope="module")
def delayed(spark):
    pick = random.Random(7)
    days = {f"k{i}": {DAY + dt.timedelta(d) for d in range(500) if pick.random() < share} for i, share in enumerate([0.02, 0.3, 0.7, 0.9, 0.97, 1.0])}
    days["gap"] = {dt.date(2023, 12, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 29), dt.date(2024, 3, 1)}
    days["one"] = {dt.date(2024, 1, 31)}
    days[None] = {dt.date(2023, 12, 30) + dt.timedelta(i) for i in range(5)}
    frame = spark.createDataFrame([(k, d) for k, own in days.items() for d in own] * 2, "k string, d date")
    return days, frame


def test_runs_over_months_and_years(spark, delayed):
    days, frame = delayed
    months = runs.month_bits(frame.repartition(7), ["k"], "d")
    found = {r.k: (r.n, r.RUN_START, r.RUN_END) for r in runs.longest_runs(months, ["k"], name="n").collect()}
    assert found == {k: longest(own) for k, own in days.items()}
    assert found["k5"][0] == 500 and found["gap"] == (2, dt.date(2024, 2, 29), dt.date(2024, 3, 1))
    by_year = {(r.k, r.YEAR): (r.n, r.RUN_START, r.RUN_END) for r in runs.longest_runs(months, ["k"], True, "n").collect()}
    assert by_year == {(k, y): longest({d for d in own if d.year == y}) for k, own in days.items() for y in {d.year for d in own}}


def test_summaries_merge_in_any_grouping(spark, delayed):
    """Months to quarters to all, and months to all, give the same summaries."""
    days, frame = delayed
    months = runs.month_bits(frame, ["k"], "d")
    spans = months.select("k", "YEAR", F.floor(F.col("MONTH") / 4).alias("part"), runs.span_of_month().alias(runs.SPAN))
    parts = runs.merge_spans(spans, ["k", "YEAR", "part"])
    years = runs.merge_spans(parts, ["k", "YEAR"])
    at_once = rows(runs.merge_spans(spans, ["k"]))
    assert rows(runs.merge_spans(years, ["k"])) == at_once == rows(runs.merge_spans(parts.repartition(5), ["k"]))
    assert [tuple(r[1])[0] for r in at_once if r[0] == "one"] == [(dt.date(2024, 1, 1) - dt.date(1970, 1, 1)).days]


def test_no_window_over_days(delayed):
    plan = plan_of(runs.longest_runs(runs.month_bits(delayed[1], ["k"], "d"), ["k"]))
    assert "Window" not in plan and "Python" not in plan


def test_month_is_replaced_not_added(spark, tmp_path):
    """A corrected month replaces its own folder; the others are not touched."""
    schema = "OP_CARRIER string, ORIGIN string, DEST string, FL_DATE date, ARR_DELAY float, YEAR int, MONTH int"

    def publish(delays):
        values = [("AA", "X", "Y", d, v, d.year, d.month) for d, v in delays.items()]
        spark.createDataFrame(values, schema).write.mode("overwrite").partitionBy("YEAR", "MONTH").parquet(f"{tmp_path}/published")

    days = {dt.date(2023, 12, 20) + dt.timedelta(i): 5.0 for i in range(30)}
    publish(days)
    jobs.append_delay_months(spark, f"{tmp_path}/published", f"{tmp_path}/months")
    assert [tuple(r) for r in jobs.longest_delay_runs(spark, f"{tmp_path}/months").collect()] == [("AA", 30, dt.date(2023, 12, 20), dt.date(2024, 1, 18))]
    december = {p: p.stat().st_mtime_ns for p in (tmp_path / "months/carrier/YEAR=2023").rglob("*.parquet")}
    days[dt.date(2024, 1, 3)] = -1.0
    publish(days)
    jobs.append_delay_months(spark, f"{tmp_path}/published", f"{tmp_path}/months", months=[(2024, 1)])
    assert [tuple(r) for r in jobs.longest_delay_runs(spark, f"{tmp_path}/months").collect()] == [("AA", 15, dt.date(2024, 1, 4), dt.date(2024, 1, 18))]
    assert december == {p: p.stat().st_mtime_ns for p in (tmp_path / "months/carrier/YEAR=2023").rglob("*.parquet")}
    by_year = rows(jobs.longest_delay_runs(spark, f"{tmp_path}/months", by_year=True).select("YEAR", "MAX_CONSEC_DELAY_DAYS"))
    assert by_year == [(2023, 12), (2024, 15)]
    # A month without delays, and one that is published no more, leave nothing behind.
    publish({d: -1.0 if d.year == 2024 else v for d, v in days.items()})
    jobs.append_delay_months(spark, f"{tmp_path}/published", f"{tmp_path}/months", months=[(2024, 1)])
    assert [r.MAX_CONSEC_DELAY_DAYS for r in jobs.longest_delay_runs(spark, f"{tmp_path}/months").collect()] == [12]
    publish({d: v for d, v in days.items() if d.year == 2024})
    jobs.append_delay_months(spark, f"{tmp_path}/published", f"{tmp_path}/months", months=[(2023, 12), (2024, 1)])
    assert [(r.YEAR, r.MAX_CONSEC_DELAY_DAYS) for r in jobs.longest_delay_runs(spark, f"{tmp_path}/months", by_year=True).collect()] == [(2024, 15)]


# As-of joins -----------------------------------------------------------------

NOON = dt.datetime(2024, 3, 31, 12)


def asof_by_hand(left, right, strict):
    out = []
    for i, key, t in left:
        ok = [(rt, v) for k, rt, v in right if None not in (key, t, k, rt) and k == key and (rt < t if strict else rt <= t)]
        out.append((i, key, t, max(ok, key=lambda x: (x[0], x[1] is not None, x[1] or 0))[1] if ok else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def sides():
    pick = random.Random(3)
    moment = lambda: None if pick.random() < 0.05 else NOON + dt.timedelta(minutes=pick.randrange(3000))
    key = lambda: pick.choice(["hot"] * 6 + ["a", "b", "c", None])
    left = [(i, key(), moment()) for i in range(800)]
    return left, [(key(), moment(), pick.randrange(1000)) for _ in range(150)] + [("c", NOON, None)]


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("per_cut", [10**9, 100, 7])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "double"])
def test_asof(spark, sides, strict, per_cut, kind):
    left, right = sides
    shown = (lambda t: None if t is None else (t - NOON).total_seconds()) if kind == "double" else (lambda t: t)
    left, right = [(i, k, shown(t)) for i, k, t in left], [(k, shown(t), v) for k, t, v in right]
    ours = spark.createDataFrame(left, f"i int, k string, t {kind}").repartition(5)
    theirs = spark.createDataFrame(right, f"k string, t {kind}, v int").repartition(3)
    found = asof.asof_join(ours, theirs, ["k"], "t", "t", ["v"], strict, per_cut)
    assert found.columns == ["i", "k", "t", "v"]
    assert rows(found) == asof_by_hand(left, right, strict)
    assert "Python" not in plan_of(found) and "CartesianProduct" not in plan_of(found) and "NestedLoop" not in plan_of(found)


def test_heavy_key_goes_to_several_tasks(spark):
    """A key with a third of all rows is cut in time; no cut has many more rows than were asked for."""
    ours = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"))
    ours = ours.withColumn("t", F.col("t").cast("double"))
    theirs = ours.select("k", "t", F.col("t").alias("v")).filter("t % 9 = 0")
    prepared = ours.select(F.col("k").alias("_k0"), F.col("t").alias("_n"))
    width, start, cuts = asof._cuts(prepared, theirs.select(F.col("k").alias("_k0"), F.col("t").alias("_n")), ["_k0"], 500)
    assert cuts >= 20
    sizes = prepared.filter("_k0 = 0").groupBy(F.floor((F.col("_n") - start) / width)).count()
    assert max(r["count"] for r in sizes.collect()) <= 600
    found = asof.asof_join(ours, theirs, ["k"], "t", "t", ["v"], rows_per_cut=500)
    assert found.filter("k = 0 AND v = floor(t / 9) * 9").count() == 10_000
    assert found.count() == 30_000


def test_asof_edges(spark):
    ours = spark.createDataFrame([(1, NOON)], "k int, t timestamp_ntz")
    none = spark.createDataFrame([], "k int, t timestamp_ntz, v int")
    assert rows(asof.asof_join(ours, none, ["k"], "t", "t", ["v"])) == [(1, NOON, None)]
    assert rows(asof.asof_join(ours.filter("false"), none, ["k"], "t", "t", ["v"])) == []
    with pytest.raises(ValueError, match="both tables"):
        asof.asof_join(ours, none, ["k"], "t", "t", ["t"])
    with pytest.raises(ValueError, match="type"):
        asof.asof_join(ours, none, ["k"], "t", "v", ["v"])


def test_rotations(spark):
    def flight(tail, day, clock, minutes, origin, dest):
        known = {"Tail_Number": tail, "FlightDate": day, "DepTime": clock, "ActualElapsedTime": minutes, "Origin": origin, "Dest": dest}
        return [known.get(c) for c in RAW_COLUMNS]

    raw = spark.createDataFrame(
        [
            flight("N1", "2024-01-01", "2300", "90.00", "OMA", "ORD"),
            flight("N1", "2024-01-02", "0100", "60.00", "ORD", "DEN"),
            flight("N1", "2024-01-02", "0130", "60.00", "ORD", "DEN"),
            flight("N2", "2024-01-02", "0700", "", "LAX", "SFO"),
            flight("N2", "2024-01-02", "0900", "50", "SEA", "SFO"),
            flight(None, "2024-01-02", "0900", "50", "SEA", "SFO"),
        ],
        ", ".join(f"`{c}` string" for c in RAW_COLUMNS),
    )
    found = rows(jobs.rotations(raw).select("Tail_Number", "Origin", "PREV_ORIGIN", "PREV_DEST", "WAITED", "MOVED", F.date_format("DEPARTED", "HHmm")))
    assert found == sorted(
        [
            ("N1", "OMA", None, None, None, None, "2300"), ("N1", "ORD", "OMA", "ORD", 30, False, "0100"),
            ("N1", "ORD", "OMA", "ORD", 60, False, "0130"), ("N2", "LAX", None, None, None, None, "0700"),
            ("N2", "SEA", None, None, None, None, "0900"), (None, "SEA", None, None, None, None, "0900"),
        ],
        key=repr,
    )


# Open intervals --------------------------------------------------------------


@pytest.mark.parametrize("cut_days", [1, 31])
def test_open_intervals(spark, cut_days):
    pick = random.Random(9)
    moment = lambda: None if pick.random() < 0.03 else dt.datetime(2024, 1, 25) + dt.timedelta(hours=pick.randrange(400))
    spans = [(pick.choice(["a", "a", "b", None]), moment(), moment()) for _ in range(600)]
    frame = spark.createDataFrame(spans, "k string, s timestamp_ntz, e timestamp_ntz").repartition(4)
    found = concurrency.open_intervals(frame, "s", "e", ["k"], "n", cut_days)
    real = [(k, s, e) for k, s, e in spans if s is not None and e is not None and e > s]
    wanted = []
    for key in {k for k, _, _ in real}:
        edges = Counter()
        for k, s, e in real:
            if k == key:
                edges[s] += 1
                edges[e] -= 1
        wanted += [(key, m, sum(1 for k, s, e in real if k == key and s <= m < e)) for m, d in edges.items() if d]
    assert rows(found) == sorted(wanted, key=repr)
    best = {k: min(((-n, m) for q, m, n in wanted if q == k)) for k in {w[0] for w in wanted}}
    assert rows(concurrency.peak(found, ["k"], "n")) == sorted(((k, -n, m) for k, (n, m) in best.items()), key=repr)
    alone = concurrency.open_intervals(frame, "s", "e", name="n").agg(F.max("n")).first()[0]
    assert alone == max(sum(1 for _, s, e in real if s <= m < e) for _, m, _ in real)


# Changes ---------------------------------------------------------------------


def test_changes_count_copies_and_nulls(spark):
    old = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 3), (None, None)], "k string, v int")
    new = spark.createDataFrame([(1, "a"), (None, "b"), (None, "b"), (4, "c"), (None, None)], "v int, k string")
    found = changes.changes(old, new)
    assert rows(found.select("k", "v", "CHANGE")) == sorted([("a", 1, -1), ("b", None, 1), ("c", 3, -1), ("c", 4, 1)], key=repr)
    assert rows(changes.apply_changes(old, found)) == rows(new.select("k", "v"))
    assert changes.changes(old, old).count() == 0 and changes.changes(old.filter("false"), new).agg(F.sum("CHANGE")).first()[0] == 5
    keys, measures = ["k"], {"v": F.col("v")}
    refreshed = changes.refresh_partials(changes.partials_of(old, keys, measures), found, keys, measures)
    assert rows(refreshed) == rows(changes.partials_of(new, keys, measures)) and len(rows(refreshed)) == 4
    gone = changes.refresh_partials(changes.partials_of(old, keys, measures), changes.changes(old, old.filter("k = 'a'")), keys, measures)
    assert rows(gone) == [("a", 2, 2, 2)]


# Sketches --------------------------------------------------------------------


def test_sketches_merge(spark):
    """Values that several parts hold count once; small counts are exact; quantiles stay within the rank error."""
    frame = spark.range(200_000).selectExpr("id % 7 AS day", "id % 50000 AS v", "CASE WHEN id % 3 = 0 THEN id % 20 END AS few", "double(id * 7919 % 200000) AS x")
    partials = sketches.sketch_partials(frame, ["day"], ["v", "few"], ["x", "few"])
    whole = sketches.estimates(sketches.merge_sketches(partials, [], ["v", "few"], ["x", "few"]), [], ["v", "few"], {"x": [0.01, 0.5, 0.99], "few": [0.5]}).first()
    assert abs(whole.v_DISTINCT - 50_000) < 0.05 * 50_000 and whole.few_DISTINCT == 20
    for percent in (1, 50, 99):
        assert abs(whole[f"x_Q{percent}"] / 200_000 - percent / 100) < sketches.RANK_ERROR
    assert 9 <= whole.few_Q50 <= 10
    at = sketches.sketches_at(partials, {"by_day": ["day"], "total": []}, ["few"])
    found = {r.GRAIN: r for r in sketches.estimates(at, ["GRAIN"], ["few"]).collect()}
    assert found["total"].few_DISTINCT == 20 and at.count() == 8
    empty = sketches.sketch_partials(frame.filter("few IS NULL").limit(5), [], ["few"], ["few"])
    assert tuple(sketches.estimates(empty, [], ["few"], {"few": [0.5]}).first()) == (0, None)


# Groups of columns -----------------------------------------------------------


def test_legs(spark):
    values = [("f1", "ORD", "0900", None, None, "DEN", None), ("f2", None, None, None, None, None, None), (None, None, None, "X", "1", None, None)]
    schema = "id string, Div1Airport string, Div1WheelsOn string, Div2Airport string, Div2WheelsOn string, Div3Airport string, Div3WheelsOn string"
    frame = spark.createDataFrame(values, schema)
    found = legs.to_legs(frame, ["id"], ["Airport", "WheelsOn"], 3)
    assert rows(found) == sorted([("f1", 1, "ORD", "0900"), ("f1", 3, "DEN", None), (None, 2, "X", "1")], key=repr)
    back = legs.from_legs(found, ["id"], ["Airport", "WheelsOn"], 3)
    assert back.columns == frame.columns and rows(back) == sorted([values[0], values[2]], key=repr)
    assert "Exchange" not in plan_of(found)
    with pytest.raises(PySparkException, match="no column for leg 3"):
        legs.from_legs(found, ["id"], ["Airport", "WheelsOn"], 2).collect()


def test_raw_files_have_such_groups():
    fields = {c[4:]: set() for c in RAW_COLUMNS if c.startswith("Div1")}
    for c in RAW_COLUMNS:
        if c[4:] in fields and c.startswith("Div"):
            fields[c[4:]].add(c[3])
    assert all(found == set("12345") for found in fields.values()) and len(fields) == 8
