"""Plans and settings that matter on large inputs."""

import os
import subprocess
import sys
import time
from pathlib import Path

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

import __spark_entry__ as driver
from skytally.plans import catalogue, jobs
from skytally.session import sized_for, sizing, stage, staged
from skytally.plans.queries import queries
from skytally.sinks.tables import ResultSink, write_published
from skytally.sources.star import flights, raw_flights
from skytally.sources.tables import keep, list_files, total_bytes

MIB = 1 << 20
NOT_ONE_PLAN = ("stream_", "ml_", "csv_", "parquet_", "flight_summary_speed", "sink_", "counts_on_write", "ingest_", "kept_", "sorted_")
BATCH_QUERIES = sorted(n for n in queries() if not n.startswith(NOT_ONE_PLAN))


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when every table is too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_python_no_cross_join_no_single_task(spark, sf_dir, name, no_broadcast):
    plan = plan_of(driver.queries()[name](spark, sf_dir))
    for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop", "BroadcastExchange"):
        assert word not in plan
    # One task may only see what a global aggregate has folded before.
    single = plan.count("SinglePartition")
    assert single == (1 if name == "label_classes" else 0)


def test_line_items_move_once_per_large_join(spark, sf_dir, no_broadcast):
    """By order key alone, when orders are all a table needs."""
    plan = plan_of(driver.queries()["canc_div_total_carrier"](spark, sf_dir))
    assert plan.count("SortMergeJoin") == 2  # orders, part
    assert "customer" not in plan and "supplier" not in plan
    plan = plan_of(driver.queries()["dist_year_carrier"](spark, sf_dir))
    assert plan.count("SortMergeJoin") == 1 and "orders" not in plan


def test_customers_meet_orders_before_line_items(spark, sf_dir, no_broadcast):
    plan = plan_of(driver.queries()["top_destinations"](spark, sf_dir))
    lineitem_side = plan[plan.index("[l_orderkey"):]
    assert lineitem_side.index("lineitem.parquet") < lineitem_side.index("customer.parquet")
    assert "hashpartitioning(o_custkey" in plan and "hashpartitioning(l_orderkey" in plan
    assert plan.count("hashpartitioning(l_") == 1


def test_scan_is_pruned_and_filters_are_pushed(spark, sf_dir, tmp_path):
    target = str(tmp_path / "t")
    flights(spark, sf_dir).write.parquet(target)
    table = spark.read.parquet(target)
    plan = plan_of(catalogue.result_table(table, "max_consec_delay_year_carrier"))
    assert "IsNotNull(FL_DATE)" in plan and "IsNotNull(ARR_DELAY)" in plan
    assert "ReadSchema: struct<FL_DATE:date,YEAR:int,OP_CARRIER:string,ARR_DELAY:double>" in plan
    plan = plan_of(catalogue.result_table(table, "src_dest_canc_code"))
    assert "EqualTo(CANCELLED,1)" in plan
    plan = plan_of(jobs.route_summary(table))
    assert "IsNotNull(Reporting_Airline)" in plan


def test_one_exchange_per_table_on_the_published_table(spark, sf_dir, tmp_path):
    target = str(tmp_path / "t")
    flights(spark, sf_dir).write.parquet(target)
    table = spark.read.parquet(target)
    for name, spec in catalogue.TABLES.items():
        plan = plan_of(catalogue.result_table(table, name))
        assert plan.count("Exchange ") == (2 if spec.family == "max_consec_delay" else 1), name
        assert "partial_" in plan
    assert plan_of(catalogue.day_partials(table)).count("Exchange ") == 1


def test_hot_key_arrives_folded(spark):
    """A key with most rows of every task reaches the exchange as one row per task."""
    hot = spark.range(0, 200_000, 1, 16).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 'HOT' ELSE string(id % 5) END AS OP_CARRIER", "double(id % 7) AS DEP_DELAY", "1D AS ARR_DELAY"
    )
    before = rows(catalogue.result_table(hot, "delay_total_carrier"))
    assert len(before) == 6
    measured = catalogue.result_table(hot, "delay_total_carrier")
    measured.collect()
    written = _metrics(measured._jdf.queryExecution().executedPlan(), "shuffleRecordsWritten")
    assert 6 <= sum(written) <= 16 * 6


def _metrics(plan, name):
    """Values of a metric over the executed plan, through adaptive stages."""
    found = []
    todo = [plan]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        metrics = node.metrics()
        if metrics.contains(name):
            found.append(metrics.apply(name).value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_sizing():
    small, middle, large = sizing(10 * MIB), sizing(10 << 40), sizing(100 << 40)
    assert small == {
        "spark.sql.files.maxPartitionBytes": 128 * MIB,
        "spark.sql.shuffle.partitions": 1,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": 64 * MIB,
    }
    assert middle["spark.sql.files.maxPartitionBytes"] == 128 * MIB
    assert middle["spark.sql.shuffle.partitions"] == 20_480
    assert large["spark.sql.files.maxPartitionBytes"] == 1024 * MIB
    assert large["spark.sql.shuffle.partitions"] == 102_400
    assert large["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == 512 * MIB


def test_settings_are_only_raised(spark):
    keys = list(sizing(0))
    before = {k: spark.conf.get(k) for k in keys}
    with sized_for(spark, 1):
        assert {k: spark.conf.get(k) for k in keys} == before
    with pytest.raises(RuntimeError), sized_for(spark, 100 << 40):
        assert {k: int(spark.conf.get(k)) for k in keys} == sizing(100 << 40)
        with sized_for(spark, 10 << 40):
            assert {k: int(spark.conf.get(k)) for k in keys} == sizing(100 << 40)
        raise RuntimeError
    assert {k: spark.conf.get(k) for k in keys} == before


def test_jobs_leave_the_settings_alone(spark, sf_dir, tmp_path):
    keys = list(sizing(0))
    before = {k: spark.conf.get(k) for k in keys}
    raw_flights(spark, sf_dir).write.option("header", True).csv(f"{tmp_path}/raw")
    jobs.preprocess(spark, f"{tmp_path}/raw", f"{tmp_path}/published")
    jobs.analyse(spark, f"{tmp_path}/published", ResultSink(f"{tmp_path}/out"), ["dist_total_carrier"])
    assert {k: spark.conf.get(k) for k in keys} == before


def test_total_bytes_runs_no_job(spark, sf_dir):
    spark.sparkContext.setJobGroup("bytes", "none is expected")
    try:
        scan = spark.read.schema("l_orderkey long").parquet(f"{sf_dir}/lineitem.parquet")
        assert total_bytes(scan) == Path(f"{sf_dir}/lineitem.parquet").stat().st_size
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("bytes")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_suppliers_meet_nations_before_line_items(spark, sf_dir, no_broadcast):
    plan = plan_of(flights(spark, sf_dir, "ORIGIN", "FL_DATE"))
    lines = [line for line in plan.splitlines() if "hashpartitioning(s_nationkey" in line or "hashpartitioning(l_" in line]
    assert not any("hashpartitioning(s_nationkey" in line and "l_shipdate" in line for line in lines) and len(lines) == 2


def test_work_folders_go_with_the_session(tmp_path):
    """The shared folder is as empty after an application as before it."""
    code = (
        "from skytally.session import build_session, stage\n"
        f"spark = build_session('w', 'local[1]', spark__checkpoint__dir='file://{tmp_path}', spark__ui__enabled='false')\n"
        "assert stage(spark.range(3), 'x').count() == 3\n"
        f"import os; assert len(os.listdir('{tmp_path}/skytally')) == 1\n"
    )
    env = os.environ | {"PYTHONPATH": str(Path(__file__).resolve().parent.parent)}
    subprocess.run([sys.executable, "-c", code], check=True, timeout=180, env=env)
    for _ in range(50):  # the JVM ends a little later
        if os.listdir(f"{tmp_path}/skytally") == []:
            break
        time.sleep(0.2)
    assert os.listdir(f"{tmp_path}/skytally") == []


def test_clustered_by_day(spark, sf_dir, tmp_path):
    source = flights(spark, sf_dir).filter("YEAR = 1996")
    write_published(source, f"{tmp_path}/m")
    write_published(source, f"{tmp_path}/d", cluster=["FL_DATE"])
    months, days = spark.read.parquet(f"{tmp_path}/m"), spark.read.parquet(f"{tmp_path}/d")
    assert rows(months) == rows(days)
    files = months.groupBy("YEAR", "MONTH").agg(F.count_distinct("_metadata.file_path").alias("n"))
    assert {r.n for r in files.collect()} == {1}


def test_staged_table_is_removed(spark, sf_dir):
    with staged(flights(spark, sf_dir, "ORIGIN"), "test") as table:
        assert table.count() == 6000
        (path,) = {r[0].rsplit("/", 1)[0] for r in table.select("_metadata.file_path").distinct().collect()}
    assert list_files(spark, path).count() == 0


def test_kept_columns(spark, sf_dir):
    kept = keep(flights(spark, sf_dir, "ORIGIN", "DEST", "YEAR"), ["ORIGIN", "YEAR"])
    try:
        assert kept.columns == ["ORIGIN", "YEAR"] and kept.storageLevel.useDisk
        assert kept.count() == 6000
        assert "InMemoryTableScan" in plan_of(kept.groupBy("YEAR").count())
    finally:
        kept.unpersist()


def test_stage_cuts_the_lineage(spark, sf_dir):
    source = flights(spark, sf_dir, "ORIGIN", "YEAR")
    staged = stage(source, "test", ["YEAR"])
    assert rows(staged.select("ORIGIN", "YEAR")) == rows(source)
    assert "lineitem" not in plan_of(staged)
