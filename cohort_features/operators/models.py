"""Estimators, bake-offs, parameter grids and cross-validation.

All learning is ``pyspark.ml``: every fit is a distributed job over the
training DataFrame; a grid search of boosted regression trees grows the same
trees for all its fits at once (``boosting``). The driver only loops over the
(few) estimators and receives scalar metrics. Training inputs are persisted once per bake-off so
that the N fits do not each recompute the feature pipeline.
"""

from __future__ import annotations

import functools

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import MinMaxScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cohort_features.functions.expressions import key_bucket
from cohort_features.operators.metrics import (
    accuracy,
    confusion_matrix,
    precision_recall_f1,
    regression_metrics,
)

# Settings used by the original application for its two deployed models.
APP_CLASSIFIER_PARAMS = {"maxDepth": 13, "maxIter": 30}
APP_REGRESSOR_PARAMS = {"maxDepth": 6, "maxIter": 30}
# The original tuning grids (maxDepth x maxIter), 5 folds.
REFERENCE_GRIDS = {
    "gbt_regressor": {"maxDepth": [5, 6, 7], "maxIter": [10, 20, 30]},
    "gbt_classifier": {"maxDepth": [11, 12, 13], "maxIter": [20, 25, 30]},
}
REFERENCE_FOLDS = 5

class NonNegative(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Clamp every vector element at 0 (column expressions, no UDF).

    Min-max scaling fitted on training rows can map a test row below 0;
    multinomial naive Bayes rejects negative inputs, so they are clamped to
    the training minimum.
    """

    def __init__(self, inputCol: str = "features", outputCol: str = "features_nn"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        arr = vector_to_array(F.col(self.getInputCol()))
        clamped = F.transform(arr, lambda x: F.greatest(x, F.lit(0.0)))
        return df.withColumn(self.getOutputCol(), array_to_vector(clamped))


CLASSIFIER_NAMES = (
    "logistic_regression", "linear_svc", "decision_tree", "random_forest",
    "gbt", "multilayer_perceptron", "naive_bayes",
)
REGRESSOR_NAMES = ("linear", "glm", "gbt", "decision_tree", "random_forest")


def classifier(
    name: str, label: str, n_features: int, n_classes: int = 2, seed: int = 42,
    features: str = "features", **params,
) -> Estimator:
    """One of the seven classifiers with the original defaults, seeded."""
    common = {"labelCol": label, "featuresCol": features}
    if name == "logistic_regression":
        return LogisticRegression(**common, **params)
    if name == "linear_svc":
        return LinearSVC(**common, **params)
    if name == "decision_tree":
        return DecisionTreeClassifier(**common, seed=seed, **params)
    if name == "random_forest":
        return RandomForestClassifier(**common, seed=seed, **params)
    if name == "gbt":
        return GBTClassifier(**common, seed=seed, **params)
    if name == "multilayer_perceptron":
        layers = params.pop("layers", [n_features, 20, 20, n_classes])
        return MultilayerPerceptronClassifier(**common, layers=layers, seed=seed, **params)
    if name == "naive_bayes":
        # multinomial NB rejects negative features: rescale to [0, 1] first
        scaled, clamped = features + "_scaled", features + "_nonneg"
        return Pipeline(stages=[
            MinMaxScaler(inputCol=features, outputCol=scaled),
            NonNegative(inputCol=scaled, outputCol=clamped),
            NaiveBayes(labelCol=label, featuresCol=clamped, smoothing=1.0,
                       modelType="multinomial", **params),
        ])
    raise ValueError(f"unknown classifier {name!r}")


def regressor(name: str, label: str, seed: int = 42, features: str = "features", **params) -> Estimator:
    """One of the five regressors with the original defaults, seeded."""
    common = {"labelCol": label, "featuresCol": features}
    if name == "linear":
        return LinearRegression(**common, **params)
    if name == "glm":
        return GeneralizedLinearRegression(**common, **params)
    if name == "gbt":
        return GBTRegressor(**common, seed=seed, **params)
    if name == "decision_tree":
        return DecisionTreeRegressor(**common, seed=seed, **params)
    if name == "random_forest":
        return RandomForestRegressor(**common, seed=seed, **params)
    raise ValueError(f"unknown regressor {name!r}")


def evaluate(pred: DataFrame, task: str, label: str) -> dict[str, float]:
    """Scalar metrics of one prediction table (one small aggregate)."""
    if task == "classification":
        row = accuracy(pred, label).first()
        return {"accuracy": row["accuracy"]}
    row = regression_metrics(pred, label).first()
    return {k: row[k] for k in ("rmse", "mae", "r2")}


METRIC_SCHEMA = StructType([
    StructField("model", StringType(), False),
    StructField("metric", StringType(), False),
    StructField("value", DoubleType(), True),
])


def sides(train: DataFrame, test: DataFrame, label: str) -> dict[str, float]:
    """Row count and mean label of the training and the test side."""
    out = {}
    for side, df in (("train", train), ("test", test)):
        row = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label)).alias("mean")).first()
        out |= {f"{side}_rows": float(row["n"]), f"{side}_label_mean": row["mean"]}
    return out


def fit_and_score(
    estimator: Estimator, train: DataFrame, test: DataFrame, task: str, label: str, name: str
) -> list[tuple[str, str, float | None]]:
    model = estimator.fit(train)
    metrics = evaluate(model.transform(test), task, label)
    return [(name, k, None if v is None else float(v)) for k, v in metrics.items()]


def bake_off(
    spark: SparkSession,
    estimators: dict[str, Estimator],
    train: DataFrame,
    test: DataFrame,
    task: str,
    label: str,
    parallel: int = 3,
) -> DataFrame:
    """Fit every estimator on ``train``, score ``test``: rows (model, metric,
    value), and for the model named ``data`` the row count and mean label of
    either side.

    ``train`` and ``test`` should be persisted, as every fit reads them.
    ``parallel`` fits run at a time, each a series of jobs of its own.
    """
    from cohort_features.operators.tuning import side_by_side

    rows = [("data", k, v) for k, v in sides(train, test, label).items()]
    work = [functools.partial(fit_and_score, est, train, test, task, label, name) for name, est in estimators.items()]
    for found in side_by_side(spark, work, parallel):
        rows += found
    return spark.createDataFrame(rows, METRIC_SCHEMA)


def fit_and_report(
    spark: SparkSession,
    estimator: Estimator,
    train: DataFrame,
    test: DataFrame,
    task: str,
    label: str,
    name: str,
) -> DataFrame:
    """Fit once and report the full evaluation as (model, metric, value) rows.

    Classification: accuracy, every confusion-matrix cell (``cm_<actual>_<predicted>``)
    and per-class precision / recall / F1; regression: RMSE, MAE, R². Only
    the K x K cells and K per-class rows reach the driver.
    """
    model = estimator.fit(train)
    pred = model.transform(test).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = [(name, k, v) for k, v in evaluate(pred, task, label).items()]
        if task == "classification":
            for c in confusion_matrix(pred, label).collect():
                rows.append((name, f"cm_{c['label']:g}_{c['prediction']:g}", float(c["n"])))
            for c in precision_recall_f1(pred, label).collect():
                for k in ("precision", "recall", "f1"):
                    rows.append((name, f"{k}_{c['class']:g}", None if c[k] is None else float(c[k])))
    finally:
        pred.unpersist()
    return spark.createDataFrame(rows, METRIC_SCHEMA)


def param_grid(estimator: Estimator, grid: dict[str, list]) -> list[dict]:
    """``ParamGridBuilder`` over named params of ``estimator``."""
    builder = ParamGridBuilder()
    for pname, values in grid.items():
        builder = builder.addGrid(estimator.getParam(pname), values)
    return builder.build()


def param_grid_frame(spark: SparkSession, grids: dict[str, dict[str, list]]) -> DataFrame:
    """The grids as rows (grid, point, param, value), point order as built."""
    rows = []
    for gname, grid in grids.items():
        est = GBTRegressor() if "regressor" in gname else GBTClassifier()
        for i, pmap in enumerate(param_grid(est, grid)):
            for p, v in sorted(pmap.items(), key=lambda kv: kv[0].name):
                rows.append((gname, i, p.name, float(v)))
    return spark.createDataFrame(rows, "grid string, point int, param string, value double")


def cross_validate(
    spark: SparkSession,
    estimator: Estimator,
    grid: dict[str, list],
    train: DataFrame,
    test: DataFrame,
    task: str,
    label: str,
    folds: int = REFERENCE_FOLDS,
    seed: int = 42,
    parallelism: int = 4,
    fold_key: str | None = None,
    staged: bool = False,
) -> DataFrame:
    """k-fold CV over ``grid``; best model refit on all of ``train`` and scored
    on ``test``. Rows: (model, metric, value) with one ``cv_<metric>`` row per
    grid point (``point<i>``) and the held-out metric(s) of the best model.

    ``fold_key`` assigns folds by a hash of that column (entity-whole,
    reproducible folds) instead of a random fold column. ``staged``, for boosted
    trees over maxDepth and maxIter with a ``fold_key``: the same values with one
    fit per fold and depth (``tuning.cross_validate_rounds``).
    """
    if staged:
        from cohort_features.operators.tuning import cross_validate_rounds

        if list(grid) != ["maxDepth", "maxIter"] or fold_key is None:
            raise ValueError("staged scores need a fold_key and a grid of maxDepth and maxIter")

        def make(depth: int, rounds: int) -> Estimator:
            return estimator.copy({estimator.maxDepth: depth, estimator.maxIter: rounds})

        out = cross_validate_rounds(spark, task, grid["maxDepth"], grid["maxIter"], train, test, label, folds, fold_key, seed, make=make)
        return out.filter(~F.col("metric").isin("maxDepth", "maxIter"))
    if task == "classification":
        evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    else:
        evaluator = RegressionEvaluator(labelCol=label, metricName="rmse")
    maps = param_grid(estimator, grid)
    kwargs = {}
    if fold_key is not None:
        train = train.withColumn("_fold", key_bucket(F.col(fold_key), folds, "fold").cast("int"))
        kwargs["foldCol"] = "_fold"
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cv = CrossValidator(
            estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator,
            numFolds=folds, seed=seed, parallelism=parallelism, **kwargs,
        )
        model = cv.fit(train)
    finally:
        train.unpersist()
    metric = evaluator.getMetricName()
    rows = [(f"point{i}", f"cv_{metric}", float(v)) for i, v in enumerate(model.avgMetrics)]
    held_out = evaluate(model.bestModel.transform(test), task, label)
    rows += [("best", k, None if v is None else float(v)) for k, v in held_out.items()]
    return spark.createDataFrame(rows, METRIC_SCHEMA)
