"""Classifiers: encoding rules, guards, metrics against Spark's evaluators and by hand."""

import random

import pytest
from conftest import rows
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from skytally.models import classifier as c

SCHEMA = (
    "MONTH int, DAYOFMONTH int, DAYOFWEEK int, OP_CARRIER string, ORIGIN string, DEST string, "
    "ARR_DELAY float, DISTANCE float, IS_DELAY int, CANCELLED int"
)


def made_up(n=600, seed=3, both=True):
    pick = random.Random(seed)
    out = []
    for _ in range(n):
        carrier = pick.choice(["A", "A", "B", "C"])
        delay = float(pick.randrange(-20, 20) + (15 if carrier == "A" else -5))
        cancelled = int(pick.random() < 0.3) if both else 0
        out.append((
            pick.randrange(1, 13), pick.randrange(1, 29), pick.randrange(1, 8), carrier, pick.choice("XYZ"), pick.choice("XYZ"),
            delay, float(pick.randrange(100, 900)), int(delay > 0), cancelled,
        ))
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(made_up(), SCHEMA).withColumn("row", F.monotonically_increasing_id())


def task(**changes):
    base = {"label": "IS_DELAY", "needed": c.DELAY.needed, "fraction": 1.0}
    return c.Task(**(base | changes))


def test_settings():
    assert (c.DELAY.fraction, c.CANCELLATION.fraction, c.DELAY.max_iter, c.DELAY.reg_param) == (0.01, 0.2, 10, 0.1)
    assert not c.DELAY.centre


def test_incomplete_rows_are_left_out(spark, table):
    hole = table.withColumn("ARR_DELAY", F.when(F.col("row") % 2 == 0, F.col("ARR_DELAY")))
    assert c.model_rows(hole, task(), ["row"]).count() == hole.filter("ARR_DELAY IS NOT NULL").count()


def test_parts(table):
    sizes = {r.PART: r["count"] for r in c.model_rows(table, task(), ["row"]).groupBy("PART").count().collect()}
    assert sum(sizes.values()) == 600 and 420 < sizes["train"] < 540


def test_sample_share(spark):
    big = spark.range(20_000).selectExpr(
        "int(id % 12 + 1) AS MONTH", "1 AS DAYOFMONTH", "1 AS DAYOFWEEK", "'A' AS OP_CARRIER", "'X' AS ORIGIN", "'Y' AS DEST",
        "float(id % 9 - 4) AS ARR_DELAY", "float(id) AS DISTANCE", "int(id % 9 > 4) AS IS_DELAY", "id AS row",
    )
    parts = {r.PART: r["count"] for r in c.model_rows(big, c.DELAY, ["row"]).groupBy("PART").count().collect()}
    # The model is fitted on a sample, and measured on all rows of the other part.
    assert 100 < parts["train"] < 220 and 3800 < parts["test"] < 4200


@pytest.mark.parametrize("label", ["IS_DELAY", "CANCELLED"])
def test_guards(spark, label):
    needed = (label,)
    one_class = spark.createDataFrame(made_up(both=False), SCHEMA).withColumn("IS_DELAY", F.lit(1))
    for frame in (one_class, one_class.limit(0)):
        with pytest.raises(c.UnfitInput):
            t = task(label=label, needed=needed)
            c.check_input(c.model_rows(frame, t, ["DISTANCE", "DAYOFMONTH"]), t)


def test_unseen_and_null_categories(spark, table):
    stages = c.preparation()[:-2]
    fitted = Pipeline(stages=stages).fit(table)
    new = spark.createDataFrame([(1, 1, 1, None, "X", "new", 1.0, 1.0, 1, 0)], SCHEMA)
    (row,) = fitted.transform(new).collect()
    assert row.INDEX_CARRIER == 3.0 and row.INDEX_DEST == 3.0
    assert row.ONEHOT_CARRIER.size == 3 and row.ONEHOT_CARRIER.numNonzeros() == 0
    assert row.ONEHOT_ORIGIN.numNonzeros() == 1


def test_index_order(spark):
    frame = spark.createDataFrame([("b",), ("b",), ("c",), ("a",)], "OP_CARRIER string")
    assert rows(c.category_indexes(frame, "OP_CARRIER")) == [("a", 1, 1), ("b", 0, 2), ("c", 2, 1)]


def test_scaling(table):
    scaled = c.feature_moments(table, "FEATURES").collect()
    assert len(scaled) == 3 + 3 + 3 + 3 + 1
    assert all(abs(r.std - 1) < 1e-9 for r in scaled)
    plain = {r.feature: r for r in c.feature_moments(table).collect()}
    expected = table.agg(F.avg("DISTANCE").alias("m"), F.stddev_samp("DISTANCE").alias("s")).first()
    assert abs(plain["DISTANCE"].mean - expected.m) < 1e-6 and abs(plain["DISTANCE"].std - expected.s) < 1e-6


def test_centring_is_optional(table):
    assert not c.preparation()[-1].getWithMean() and c.preparation(centre=True)[-1].getWithMean()
    sparse = Pipeline(stages=c.preparation()).fit(table).transform(table).first().FEATURES
    assert type(sparse).__name__ == "SparseVector"


def test_training_end_to_end(spark, table, tmp_path):
    t = task()
    model, measured, scored = c.fit_and_measure(table, t, f"{tmp_path}/model", ["row"])
    (row,) = measured.collect()
    for metric, value in (("accuracy", row.accuracy), ("f1", row.f1)):
        evaluator = MulticlassClassificationEvaluator(metricName=metric, labelCol=t.label, predictionCol="prediction")
        assert abs(evaluator.evaluate(scored) - value) < 1e-12
    assert row.test_rows == scored.count() and row.train_rows + row.test_rows == 600
    assert row.train_negatives + row.train_positives == row.train_rows
    cells = [row.true_negatives, row.false_positives, row.false_negatives, row.true_positives]
    assert sum(cells) == row.test_rows and abs((cells[0] + cells[3]) / row.test_rows - row.accuracy) < 1e-12
    assert row.accuracy > 0.7
    again = c.score(c.load_model(f"{tmp_path}/model"), table.filter("row < 50")).select("row", "prediction")
    assert rows(again) == rows(c.score(model, table.filter("row < 50")).select("row", "prediction"))
    assert c.score_preview(scored, t.label, 3).columns == ["prediction", "IS_DELAY", "rawPrediction"]
    # The same rows in another partitioning give the same parts and metrics.
    _, other, _ = c.fit_and_measure(table.repartition(3), t, f"{tmp_path}/other", ["row"])
    assert other.first().test_rows == row.test_rows


def test_weights(table, tmp_path):
    weighted = table.withColumn("w", F.when(F.col("CANCELLED") == 1, 5.0).otherwise(1.0))
    t = task(label="CANCELLED", needed=c.CANCELLATION.needed, weight_column="w")
    _, measured, scored = c.fit_and_measure(weighted, t, f"{tmp_path}/m", ["row"])
    assert scored.filter("prediction = 1").count() > 0


def test_metrics_by_hand(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(1, 1)] * 2
    frame = spark.createDataFrame([(a, float(b)) for a, b in pairs], "y int, prediction double")
    (row,) = c.metrics(c.confusion(frame, "y")).collect()
    f_zero, f_one = 2 * 5 / (7 + 6), 2 * 2 / (3 + 4)
    assert row.test_rows == 10 and row.accuracy == 0.7
    assert abs(row.f1 - (6 * f_zero + 4 * f_one) / 10) < 1e-12
