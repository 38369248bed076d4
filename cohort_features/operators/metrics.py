"""Evaluation metrics as DataFrames.

Each metric is one aggregate over the prediction table (partial aggregation,
one shuffle of a handful of rows); only the tiny result ever reaches a
caller. Precision and recall follow the usual definitions (rows = actual,
columns = predicted) for every class, so the positive class is a parameter
of the reader, not a hard-coded matrix cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows with prediction == label, as ``accuracy``."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("int")
    return pred.agg((F.sum(hit) / F.count(F.lit(1))).alias("accuracy"))


def confusion_matrix(
    pred: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """(label, prediction, n): one row per non-empty cell."""
    return pred.groupBy(
        F.col(label).cast("double").alias("label"),
        F.col(prediction).cast("double").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("n"))


def precision_recall_f1(
    pred: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Per class: tp, predicted, actual, precision, recall, f1.

    precision = tp / predicted-as-class, recall = tp / actually-class; NULL
    where the denominator is 0.
    """
    cells = confusion_matrix(pred, label, prediction)
    per_class = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("class"), F.lit(0).alias("is_pred"), "n",
                         (F.col("label") == F.col("prediction")).alias("hit")),
                F.struct(F.col("prediction").alias("class"), F.lit(1).alias("is_pred"), "n",
                         F.lit(False).alias("hit")),
            )
        ).alias("c")
    ).select("c.*")
    counts = per_class.groupBy("class").agg(
        F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("is_pred") == 1, F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when(F.col("is_pred") == 0, F.col("n")).otherwise(0)).alias("actual"),
    )
    precision = F.try_divide(F.col("tp").cast("double"), F.col("predicted").cast("double"))
    recall = F.try_divide(F.col("tp").cast("double"), F.col("actual").cast("double"))
    return counts.select(
        "class", "tp", "predicted", "actual",
        precision.alias("precision"), recall.alias("recall"),
    ).withColumn(
        "f1",
        F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
    )


def regression_metrics(
    pred: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """rmse, mse, mae, r2 (1 - SSres / SStot), n and n_skipped in one aggregate.

    All five metrics are over the rows that have both values; ``n_skipped``
    says how many had not.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    both = y.isNotNull() & p.isNotNull()
    y, err = F.when(both, y), F.when(both, p - y)
    agg = pred.agg(
        F.count(y).alias("n"),
        F.count_if(~both).alias("n_skipped"),
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_ss_res"),
        (F.var_pop(y) * F.count(y)).alias("_ss_tot"),
    )
    return agg.select(
        F.sqrt("mse").alias("rmse"),
        "mse",
        "mae",
        (F.lit(1.0) - F.try_divide(F.col("_ss_res"), F.col("_ss_tot"))).alias("r2"),
        "n",
        "n_skipped",
    )
