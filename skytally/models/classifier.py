"""Delay and cancellation classifiers: input, training, scoring, metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.operators.normalise import required
from skytally.operators.sampling import bucket_split, in_share
from skytally.session import stage

CATEGORIES = {"OP_CARRIER": "CARRIER", "ORIGIN": "ORIGIN", "DEST": "DEST"}
CALENDAR = ["MONTH", "DAYOFMONTH", "DAYOFWEEK"]
MEASURES = ["DISTANCE"]
TRAIN, TEST = "train", "test"


@dataclass(frozen=True)
class Task:
    """What to predict, from which rows.

    ``fraction`` bounds what the model is fitted on: this share of the training part. The test part is measured whole.
    """

    label: str
    needed: tuple[str, ...]
    fraction: float
    max_iter: int = 10
    reg_param: float = 0.1
    train_share: float = 0.8
    # Centring fills every slot of the sparse one-hot vectors; scaling alone does not.
    centre: bool = False
    weight_column: str | None = None

    @property
    def columns(self) -> list[str]:
        extra = [self.weight_column] if self.weight_column else []
        return list(dict.fromkeys([*CALENDAR, *CATEGORIES, *MEASURES, *self.needed, self.label, *extra]))


# Sample shares and solver settings of the two models.
DELAY = Task(label="IS_DELAY", needed=("ARR_DELAY", "DISTANCE", "OP_CARRIER", "ORIGIN", "DEST"), fraction=0.01)
CANCELLATION = Task(label="CANCELLED", needed=("CANCELLED", "DISTANCE", "OP_CARRIER", "ORIGIN", "DEST"), fraction=0.2)


class UnfitInput(ValueError):
    """The rows cannot train a two-class model."""


def model_rows(df: DataFrame, task: Task, sample_by: Sequence[str] | None = None, portable: bool = False) -> DataFrame:
    """Columns of a task, its complete rows and their part; of the training part a sample.

    ``sample_by`` are the columns that identify a row for sampling; by default
    all columns of ``df``. Membership is repeatable, so a task that is run
    again after a lost executor trains on the same rows.
    """
    complete = required(df, task.needed)
    by = list(sample_by or df.columns)
    shares = {TRAIN: task.train_share, TEST: 1 - task.train_share}
    parts = bucket_split(complete, by, shares, salt="split", portable=portable)
    used = (F.col("PART") == TEST) | in_share(by, task.fraction, "sample", portable)
    return parts.filter(used).select(*task.columns, "PART")


def check_input(rows: DataFrame, task: Task) -> dict[str, int]:
    """Counts of one aggregate pass; raises :class:`UnfitInput` on empty or one-class input."""
    training = F.col("PART") == TRAIN
    found = rows.agg(
        F.count("*").alias("rows"),
        F.count_if(training).alias("train_rows"),
        F.count_if(training & (F.col(task.label) == 0)).alias("negatives"),
        F.count_if(training & (F.col(task.label) == 1)).alias("positives"),
    ).first().asDict()
    if not found["negatives"] or not found["positives"]:
        raise UnfitInput(f"{task.label} needs training rows of both classes, found {found}")
    return found


def indexing(names: dict[str, str] = CATEGORIES) -> StringIndexer:
    """Most frequent value first, ties by value; NULL and unseen values share the last index.

    The values are listed on the driver. They are carriers and airports, a domain that does not grow with the rows.
    """
    return StringIndexer(
        inputCols=list(names), outputCols=[f"INDEX_{n}" for n in names.values()], handleInvalid="keep"
    )


def preparation(centre: bool = False) -> list:
    """Stages from columns to the scaled feature vector."""
    names = list(CATEGORIES.values())
    encoded = [f"ONEHOT_{n}" for n in names]
    return [
        indexing(),
        # The slot that is dropped is the unseen one: unseen values give a zero vector.
        OneHotEncoder(inputCols=[f"INDEX_{n}" for n in names], outputCols=encoded),
        VectorAssembler(inputCols=[*CALENDAR, *encoded, *MEASURES], outputCol="FEATURES_UNSCALED"),
        StandardScaler(inputCol="FEATURES_UNSCALED", outputCol="FEATURES", withStd=True, withMean=centre),
    ]


def classifier(task: Task) -> Pipeline:
    solver = LinearSVC(
        maxIter=task.max_iter, regParam=task.reg_param, labelCol=task.label, featuresCol="FEATURES"
    )
    if task.weight_column:
        solver = solver.setWeightCol(task.weight_column)
    return Pipeline(stages=[*preparation(task.centre), solver])


def train(rows: DataFrame, task: Task) -> PipelineModel:
    return classifier(task).fit(rows.filter(F.col("PART") == TRAIN))


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows)


def score_columns(scored: DataFrame, label: str) -> DataFrame:
    """Prediction, label and the score column the classifier offers."""
    value = "probability" if "probability" in scored.columns else "rawPrediction"
    return scored.select("prediction", label, value)


def score_preview(scored: DataFrame, label: str, rows: int = 20) -> DataFrame:
    """Some first rows of :func:`score_columns`."""
    return score_columns(scored, label).limit(rows)


def label_of(model: PipelineModel) -> str:
    """The label that a saved pipeline's classifier was fitted to."""
    return model.stages[-1].getLabelCol()


def confusion(scored: DataFrame, label: str) -> DataFrame:
    """Rows per pair of label and prediction: all that the metrics need, from one scoring pass."""
    pair = [F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")]
    return scored.select(*pair).groupBy("label", "prediction").agg(F.count("*").alias("n"))


def metrics(matrix: DataFrame) -> DataFrame:
    """Accuracy and F1 weighted by class size, as one row.

    The matrix has one row per pair of classes, so the sums run over few rows.
    """
    n = F.col("n")
    right = F.when(F.col("label") == F.col("prediction"), n).otherwise(0)
    actual = F.struct(F.col("label").alias("class"), n.alias("actual"), F.lit(0).alias("guessed"), right.alias("right"))
    guessed = F.struct(
        F.col("prediction").alias("class"), F.lit(0).alias("actual"), n.alias("guessed"), F.lit(0).alias("right")
    )
    sides = (
        matrix.select(F.explode(F.array(actual, guessed)).alias("side"))
        .select("side.*")
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "guessed", "right")])
    )
    # 2pr / (p + r) with p = right/guessed and r = right/actual; 0 for a class that is never hit.
    f1 = F.col("right") * 2.0 / (F.col("guessed") + F.col("actual"))
    return sides.agg(
        F.sum("actual").alias("test_rows"),
        F.try_divide(F.sum("right"), F.sum("actual")).alias("accuracy"),
        F.try_divide(F.sum(f1 * F.col("actual")), F.sum("actual")).alias("f1"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_and_measure(
    df: DataFrame, task: Task, path: str, sample_by: Sequence[str] | None = None, portable: bool = False
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Train on one part, save to ``path``, measure the saved model on the other part.

    Returns the model, one row of metrics and the scored test rows. The row has the part sizes, the classes of the
    training rows and the confusion matrix: accuracy alone hides a model that never predicts a rare class. The
    rows are written to the shared folder for the passes of the fit, so that
    none of them reads the source again. The model is read back because a
    freshly fitted one holds on to its training session, which cannot be sent
    to tasks once the session has observed a query.
    """
    rows = stage(model_rows(df, task, sample_by, portable), "model-rows")
    found = check_input(rows, task)
    save_model(train(rows, task), path)
    model = load_model(path)
    scored = score(model, rows.filter(F.col("PART") == TEST))
    matrix = stage(confusion(scored, task.label), "confusion")
    result = metrics(matrix).first()
    cells = {(r["label"], r["prediction"]): r["n"] for r in matrix.collect()}  # a row for each pair of classes
    hits = [cells.get((label, guess), 0) for label in (0, 1) for guess in (0, 1)]
    table = df.sparkSession.createDataFrame(
        [(task.label, found["train_rows"], found["negatives"], found["positives"], *result, *hits)],
        "label string, train_rows bigint, train_negatives bigint, train_positives bigint, test_rows bigint, "
        "accuracy double, f1 double, true_negatives bigint, false_positives bigint, false_negatives bigint, "
        "true_positives bigint",
    )
    return model, table, scored


def category_indexes(df: DataFrame, column: str) -> DataFrame:
    """Index and frequency of each value of one column, as the indexer assigns them."""
    fitted = indexing({column: column}).fit(df.select(column))
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return fitted.transform(counts).select(
        F.col(column).alias("value"), F.col(f"INDEX_{column}").cast("int").alias("value_index"), "n"
    )


def feature_moments(df: DataFrame, output: str = "FEATURES_UNSCALED") -> DataFrame:
    """Mean and standard deviation of each slot of the assembled vector, by slot name.

    One row is computed over all the data and spread out over its slots, whose
    number does not grow with the rows.
    """
    stages = preparation()
    # The scaler needs a pass of its own; it is fitted only when its output is asked for.
    prepared = Pipeline(stages=stages if output == "FEATURES" else stages[:-1]).fit(df).transform(df)
    attributes = prepared.schema["FEATURES_UNSCALED"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attributes.values() for a in group}
    summary = prepared.agg(Summarizer.metrics("mean", "std").summary(F.col(output)).alias("s"))
    slots = F.arrays_zip(
        F.array(*[F.lit(names[i]) for i in range(len(names))]).alias("feature"),
        vector_to_array("s.mean").alias("mean"),
        vector_to_array("s.std").alias("std"),
    )
    return summary.select(F.explode(slots).alias("slot")).select("slot.*")
