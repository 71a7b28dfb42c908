"""Complete jobs and the command line, on files made from the star."""

import pytest
from conftest import rows

from skytally import cli
from skytally.plans import catalogue, jobs
from skytally.session import shared_folder, work_folder
from skytally.sinks.tables import ResultSink, connector_batch_writer, search_index_sink
from skytally.sources import messages, tables
from skytally.sources.star import flights, raw_flights


@pytest.fixture(scope="module")
def csv(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv") / "raw")
    raw_flights(spark, sf_dir).write.option("header", True).csv(path)
    return path


@pytest.fixture(scope="module")
def published(spark, csv, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("published") / "table")
    assert jobs.preprocess(spark, csv, path) == {"read": 6000, "written": 6000}
    return path


@pytest.mark.parametrize("one_pass", [True, False])
def test_analysis_job(spark, sf_dir, published, tmp_path, one_pass):
    names = jobs.analyse(spark, published, ResultSink(str(tmp_path)), one_pass=one_pass)
    assert names == list(catalogue.TABLES)
    for name in ("delay_total_carrier", "canc_div_year_month_src_dest", "dist_dayofweek_carrier", "max_consec_delay_year_src_dest", "src_dest_canc_code"):
        expected = catalogue.result_table(flights(spark, sf_dir), name)
        assert rows(spark.read.parquet(f"{tmp_path}/{name}").select(*expected.columns)) == rows(expected)


def test_summary_and_ranking_jobs(spark, csv, sf_dir, tmp_path):
    for infer in (False, True):
        sink = ResultSink(f"{tmp_path}/{infer}")
        jobs.summarise(spark, csv, sink, infer)
        jobs.rank_destinations(spark, csv, sink, 10, infer)
        summary = spark.read.parquet(f"{tmp_path}/{infer}/flight_summary_batch")
        assert rows(summary) == rows(jobs.route_summary(flights(spark, sf_dir)))
        top = spark.read.parquet(f"{tmp_path}/{infer}/flight_wordcloud")
        assert rows(top) == rows(jobs.top_destinations(flights(spark, sf_dir), 10))


def test_publish_job(spark, csv, tmp_path):
    jobs.publish(spark, csv, "text", f"{tmp_path}/raw")
    jobs.publish(spark, csv, "text", f"{tmp_path}/filled", fill=True)
    cancelled = tables.read_raw_csv(spark, csv).filter("ArrDelay IS NULL").count()
    for name, missing in (("raw", cancelled), ("filled", 0)):
        parsed = messages.parse_messages(spark.read.text(f"{tmp_path}/{name}"))
        assert parsed.count() == 6000 and parsed.filter("ArrDelay IS NULL").count() == missing


def test_training_job(spark, published, tmp_path):
    result = {r.label: r for r in jobs.train(spark, published, str(tmp_path)).collect()}
    assert set(result) == {"IS_DELAY", "CANCELLED"}
    assert (tmp_path / "delay_prediction" / "metadata").exists() and (tmp_path / "cancellation_prediction").exists()
    assert all(0 <= r.accuracy <= 1 and 0 <= r.f1 <= 1 for r in result.values())
    assert all(r.true_positives + r.false_negatives > 0 for r in result.values())
    jobs.score(spark, published, f"{tmp_path}/delay_prediction", f"{tmp_path}/scored", preview=2)
    scored = spark.read.parquet(f"{tmp_path}/scored")
    assert scored.count() == 6000 and {r[0] for r in scored.select("prediction").distinct().collect()} <= {0.0, 1.0}


def test_broker_options_and_what_wins_over_them():
    args = cli.parser().parse_args(
        ["speed", "--target", "t", "--checkpoint", "c", "--format", "kafka", "--servers", "b:9092", "--topic", "f"]
        + ["--option", "startingOffsets=latest"]
    )
    assert cli._options(args, messages.kafka_options) == messages.kafka_options("b:9092", "f", "latest")
    args = cli.parser().parse_args(["publish", "--source", "s", "--format", "kafka", "--servers", "b:9092", "--topic", "f"])
    assert cli._options(args, messages.kafka_writer_options) == messages.kafka_writer_options("b:9092", "f")


def test_a_sink_without_ids_takes_no_micro_batches(tmp_path):
    with pytest.raises(ValueError, match="ids"):
        connector_batch_writer(ResultSink(str(tmp_path)), "raw")


def test_single_ids_are_never_null(spark, tmp_path):
    sink = ResultSink(str(tmp_path), "json", id_option="key")
    sink.write(spark.createDataFrame([("a", 1), (None, 2)], "k string, n int"), "t", ["k"])
    assert rows(spark.read.json(f"{tmp_path}/t").select("k", "n")) == [("(none)", 2), ("a", 1)]


def test_command_line(spark, csv, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    target = f"{tmp_path}/published"
    cli.main(["preprocess", "--source", csv, "--target", target])
    cli.main(["analyse", "--source", target, "--target", f"{tmp_path}/results", "--tables", "delay_total_carrier", "--separate"])
    expected = catalogue.result_table(flights(spark, sf_dir), "delay_total_carrier")
    assert rows(spark.read.parquet(f"{tmp_path}/results/delay_total_carrier")) == rows(expected)
    cli.main(["rank", "--source", csv, "--target", f"{tmp_path}/json", "--format", "json", "--k", "3"])
    assert spark.read.json(f"{tmp_path}/json/flight_wordcloud").count() == 3
    cli.main(["publish", "--source", csv, "--target", f"{tmp_path}/messages"])
    cli.main([
        "speed", "--source", f"{tmp_path}/messages", "--target", f"{tmp_path}/speed", "--checkpoint", f"{tmp_path}/cp",
        "--interval", "1 second", "--timeout", "25",
    ])
    assert spark.read.parquet(f"{tmp_path}/speed/raw").count() == 6000


def test_sink_options():
    """Connector options are put together without the connector's jar."""

    class Writer:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def options(self, **options):
            self.seen |= options
            return self

        def mode(self, mode):
            self.seen["mode"] = mode
            return self

        def save(self):
            pass

    class Frame:
        write = Writer()

        def withColumn(self, name, column):
            return self

    search_index_sink("flights_", "http://search:9200").write(Frame(), "delay", ["OP_CARRIER"])
    assert Frame.write.seen == {
        "format": "org.elasticsearch.spark.sql", "mode": "overwrite", "es.nodes": "http://search:9200",
        "es.resource": "flights_delay", "es.mapping.id": "OP_CARRIER",
    }
    assert messages.kafka_options("b:9092", "t")["startingOffsets"] == "earliest"
    assert messages.kafka_writer_options("b:9092", "t")["kafka.acks"] == "all"


def test_keyed_appends(spark, tmp_path):
    """Connector writers append every batch under the names of the two streams, keyed by id."""
    sink = ResultSink(str(tmp_path), "json", id_option="key")
    write_raw, write_counts = jobs.connector_writers(sink)
    for batch_id in (0, 1):
        write_raw(spark.createDataFrame([("a", batch_id)], "id string, n int"), batch_id)
    write_counts(spark.createDataFrame([("x", 1)], "id string, n int"), 0)
    assert spark.read.json(f"{tmp_path}/raw").count() == 2
    assert spark.read.json(f"{tmp_path}/by_origin").count() == 1


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    assert work_folder(spark, "x") != work_folder(spark, "x")


def test_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
