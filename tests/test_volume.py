"""What large inputs move and write: text files, the star's joins, the published table, parsed messages."""

import gzip
import re
import time
from pathlib import Path

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from skytally.operators import rollups
from skytally.operators.normalise import clean, project_published
from skytally.plans import jobs, queries
from skytally.schemas import PUBLISHED_COLUMNS
from skytally.session import freed_exchanges, sized_for
from skytally.sinks.tables import write_published
from skytally.sources import messages, tables
from skytally.sources.star import raw_flights


def test_staged_text_is_compressed_and_whole(spark, sf_dir):
    folder = queries._staged_csv(spark, sf_dir)
    files = list(Path(folder.removeprefix("file:")).glob("part-*"))
    assert files and all(f.name.endswith(".csv.gz") for f in files)
    text = sum(len(gzip.decompress(f.read_bytes())) for f in files)
    assert sum(f.stat().st_size for f in files) * 4 < text
    assert tables.read_raw_csv(spark, folder).count() == raw_flights(spark, sf_dir).count()


def test_compressed_text_counts_as_the_text_it_holds(spark, tmp_path):
    written = spark.range(1000).selectExpr("string(id) AS a").repartition(2).write.option("header", True)
    written.option("compression", "gzip").csv(str(tmp_path / "gz"))
    size = sum(f.stat().st_size for f in (tmp_path / "gz").glob("part-*"))
    assert tables.total_bytes(spark.read.csv(str(tmp_path / "gz"))) == tables.TEXT_IN_COMPRESSED * size


def test_line_items_are_not_moved_by_a_small_table(spark, sf_dir):
    plan = plan_of(raw_flights(spark, sf_dir))
    assert "l_suppkey" in plan and "hashpartitioning(l_suppkey" not in plan


def test_rows_that_meet_by_date_move_once(spark, tmp_path):
    kinds = {"date": "date", "float": "float", "flag": "int", "text": "string"}
    given = {
        "FL_DATE": "CASE WHEN id % 7 > 0 THEN date_add(DATE'2024-01-30', int(id % 5)) END",
        "DEP_DELAY": "float(id % 3)",
        "ORIGIN": "CASE WHEN id % 2 = 0 THEN 'A' END",
    }
    some = spark.range(60).selectExpr(*[f"{given.get(n, 'NULL')} AS {n}" for _, n, _ in PUBLISHED_COLUMNS])
    some = some.select([F.col(n).cast(kinds[k]).alias(n) for _, n, k in PUBLISHED_COLUMNS])
    met = clean(some.unionByName(some), ["FL_DATE"])
    assert plan_of(met).count("Exchange ") == 1
    expected = rows(clean(some))
    assert rows(met) == expected
    write_published(met, str(tmp_path / "t"), gathered=True)
    assert rows(tables.read_published(spark, str(tmp_path / "t"))) == expected


@pytest.mark.parametrize(
    "line", ['{"Origin":"A","DepDelay":1.5,"Dest":"B"}', '{"Origin":"A","DepDelay":"x","Flights":"y"}', "{bad", "null", '{"Dest":{"a":1},"Origin":"A"}']
)
def test_wanted_fields_read_as_with_all_others(spark, line):
    given = spark.createDataFrame([(line, 1)], "value string, n int")
    wanted = ["Origin", "DepDelay"]
    found = messages.parse_messages(given, columns=wanted)
    assert found.columns == [*wanted, "n"]
    assert rows(found) == rows(messages.parse_messages(given).select(*wanted, "n"))


def test_queries_convert_the_fields_they_use(spark, sf_dir):
    plan = queries.delay_defaults(spark, sf_dir)._jdf.queryExecution().analyzed().toString()
    parsed = plan[plan.index("from_json("):]
    assert "StructField(DepDelay,DoubleType" in parsed and "StructField(Tail_Number" not in parsed


def test_wide_projections_make_no_long_method(spark, sf_dir):
    """HotSpot compiles no method above 8,000 bytes; one near that grows over it with the join that runtime planning picks."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = queries.normalise_flights(spark, sf_dir)._jdf.queryExecution()
        code = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 6000


def test_numbers_are_read_from_text_one_by_one(spark):
    texts = ["1.50", "", None, "x", " 7 ", "1e40", "-0.25", "NaN"]
    names = [(source, name, kind) for source, name, kind in PUBLISHED_COLUMNS if kind != "text"]
    raw = spark.createDataFrame(
        [[texts[(i + j) % len(texts)] for j in range(len(names))] for i in range(len(texts))],
        ", ".join(f"{source} string" for source, _, _ in names),
    )
    kinds = {"date": "try_to_date({}, 'yyyy-MM-dd')", "float": "try_cast({} AS float)", "flag": "try_cast(try_cast({} AS double) AS int)"}
    plain = raw.selectExpr(*[f"{kinds[kind].format(source)} AS {name}" for source, name, kind in names])
    found = project_published(raw, names)
    assert found.schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


def test_distinct_counts_of_many_values(spark):
    """Values that repeat within and between groups, no value at all, keys that are NULL, a value that most rows hold."""
    grains = {"none": [], "a": ["a"], "a_b": ["a", "b"], "a_c": ["a", "c"], "d": ["d"], "d_b": ["d", "b"]}
    given = {
        "a": "nullif(id % 4, 3)", "b": "nullif(id % 3, 2)", "c": "id % 2", "d": "nullif(string(id % 5), '4')",
        "v": "CASE WHEN id % 2 = 0 THEN 'most' WHEN id % 4 > 0 AND id % 5 < 4 THEN string(id % 37) END", "w": "nullif(id % 6, 1)",
    }
    frame = spark.range(400).selectExpr(*[f"{e} AS {c}" for c, e in given.items()]).repartition(5)
    keys = ["a", "b", "c", "d"]
    found = rollups.distinct_counts(frame.drop("c"), grains, "v", "w", ["nv", "nw"], {"c": F.when(F.col("a").isNotNull(), F.col("b") % 2)})
    frame = frame.withColumn("c", F.when(F.col("a").isNotNull(), F.col("b") % 2))
    plain = rollups.grouped_sets(frame, grains, keys, [F.count_distinct("v").alias("nv"), F.count_distinct("w").alias("nw")])
    order = ["GRAIN", "a", "b", "d", "c", "nv", "nw"]
    assert rows(found.select(order)) == rows(plain.filter("nv + nw > 0").select(order))


def test_flight_numbers_are_not_sent_for_every_grain(spark, sf_dir):
    query = queries.distinct_sketches(spark, sf_dir)
    assert "count(distinct OP_CARRIER_FL_NUM" not in query._jdf.queryExecution().analyzed().toString()
    assert plan_of(query).count("hashpartitioning(OP_CARRIER_FL_NUM#") == 1


def test_rows_are_sent_by_date_in_few_bytes(spark, sf_dir, tmp_path, monkeypatch):
    """In the order of routes, numbers as one array; the rows are those of the plain way."""
    plans, write = [], jobs.write_published
    monkeypatch.setattr(jobs, "write_published", lambda df, *given, **named: (plans.append(plan_of(df)), write(df, *given, **named)))
    source = queries._staged_csv(spark, sf_dir)
    counts = jobs.preprocess(spark, source, str(tmp_path / "t"))
    below = plans[0][plans[0].index("Exchange hashpartitioning(FL_DATE"):]
    assert "Sort [ORIGIN" in below and "AS __floats" in below
    plain = clean(project_published(tables.read_raw_csv(spark, source)))
    expected = rows(plain)
    assert counts["written"] == len(expected) and rows(tables.read_published(spark, str(tmp_path / "t")).select(plain.columns)) == expected


def test_a_split_of_compressed_text_has_as_many_rows(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    with sized_for(spark, 1 << 30, tables.TEXT_IN_COMPRESSED):
        assert int(spark.conf.get(key)) == (128 << 20) // tables.TEXT_IN_COMPRESSED
    assert spark.conf.get(key) == before


def test_files_of_exchanges_go_with_their_query(spark, tmp_path):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    kept = lambda: {files.getAllFiles().apply(i).getName() for i in range(files.getAllFiles().size())}
    before = kept()
    with freed_exchanges(spark):
        spark.range(1000).repartition(3).write.parquet(str(tmp_path / "t"))
    until = time.time() + 20
    while kept() - before and time.time() < until:
        time.sleep(0.2)
    assert not kept() - before
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000
