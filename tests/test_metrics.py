"""Metric aggregates: definitions, and agreement with pyspark.ml evaluators."""

from __future__ import annotations

import math

from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator

from cohort_features.operators import metrics

# (label, prediction, n) -> accuracy 12/17; class 0: precision 5/7, recall 5/8, F1 2/3;
# class 1: precision 7/10, recall 7/9. Swapping precision and recall fails here.
CELLS = [(0, 0, 5), (0, 1, 3), (1, 0, 2), (1, 1, 7)]


def _preds(spark):
    rows = [(float(y), float(p)) for y, p, n in CELLS for _ in range(n)]
    return spark.createDataFrame(rows, "label double, prediction double")


def test_accuracy(spark):
    assert math.isclose(metrics.accuracy(_preds(spark)).first()["accuracy"], 12 / 17)


def test_confusion_matrix(spark):
    got = {(r["label"], r["prediction"]): r["n"] for r in metrics.confusion_matrix(_preds(spark)).collect()}
    assert got == {(float(y), float(p)): n for y, p, n in CELLS}
    assert sum(got.values()) == 17


def test_precision_recall_f1(spark):
    got = {r["class"]: r for r in metrics.precision_recall_f1(_preds(spark)).collect()}
    assert math.isclose(got[0.0]["precision"], 5 / 7)
    assert math.isclose(got[0.0]["recall"], 5 / 8)
    assert math.isclose(got[0.0]["f1"], 2 / 3)
    assert math.isclose(got[1.0]["precision"], 7 / 10)
    assert math.isclose(got[1.0]["recall"], 7 / 9)


def test_matches_multiclass_evaluator(spark):
    df = _preds(spark)
    for name, col, cls in [("precisionByLabel", "precision", 0.0), ("recallByLabel", "recall", 0.0),
                           ("precisionByLabel", "precision", 1.0), ("recallByLabel", "recall", 1.0)]:
        ev = MulticlassClassificationEvaluator(metricName=name, metricLabel=cls)
        ours = {r["class"]: r[col] for r in metrics.precision_recall_f1(df).collect()}[cls]
        assert math.isclose(ev.evaluate(df), ours)
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    assert math.isclose(ev.evaluate(df), metrics.accuracy(df).first()["accuracy"])


def test_regression_metrics_match_evaluator(spark):
    rows = [(float(i), float(i) + ((i * 7) % 5 - 2) * 0.5) for i in range(200)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = metrics.regression_metrics(df).first()
    for m in ("rmse", "mse", "mae", "r2"):
        assert math.isclose(RegressionEvaluator(metricName=m).evaluate(df), ours[m], rel_tol=1e-9), m
    assert ours["n"] == 200


def test_regression_metrics_skip_rows_without_both_values(spark):
    rows = [(1.0, 1.5), (2.0, 2.0), (3.0, 2.5), (100.0, None), (None, 7.0)]
    got = metrics.regression_metrics(spark.createDataFrame(rows, "label double, prediction double")).first()
    assert (got["n"], got["n_skipped"]) == (3, 2)
    assert math.isclose(got["r2"], 1 - 0.5 / 2.0) and math.isclose(got["mae"], 1 / 3)
