"""Fitted pipelines: train, save, load, score any DataFrame.

A pipeline bundles the vector assembly with the model, so scoring takes raw
feature columns from any source (a table of new patients, a stream batch)
and returns a ``prediction`` column, as a distributed ``transform``.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession

from cohort_features.session import remove


def fit_pipeline(train: DataFrame, feature_cols: list[str], estimator: Estimator) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="error")
    return Pipeline(stages=[assembler, estimator]).fit(train)


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_batch(model: PipelineModel, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``prediction`` for every row of ``df`` (rows with a NULL input raise)."""
    out = model.transform(df)
    return out.select(*(keep or []), "prediction")


def reloaded(model: PipelineModel, path: str) -> PipelineModel:
    """The model saved to ``path`` and loaded again; the files are removed, as
    a loaded model is in memory."""
    save_pipeline(model, path)
    out = load_pipeline(path)
    remove(SparkSession.getActiveSession(), path)
    return out
