"""Feature tables: merge, complete cases, vectors, splits."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_features.functions.catalog import (
    CLASSIFICATION_LABEL,
    CLINICAL_CATALOGUE,
    REGRESSION_LABEL,
    MeasureCatalogue,
    vector_columns,
)
from cohort_features.functions.expressions import array_slots, key_bucket
from cohort_features.operators.cohort import stay_cohort
from cohort_features.operators.measures import subject_measures


def complete_cases(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with NULL (or NaN) in ``cols`` (all columns if omitted)."""
    return df.dropna(how="any", subset=cols)


def stay_features(
    tables: dict[str, DataFrame],
    catalogue: MeasureCatalogue = CLINICAL_CATALOGUE,
    item_col: str = "itemid",
    code_source: str | None = None,
) -> DataFrame:
    """The full feature table: one row per ICU stay, every measure of the
    stay's subject, cohort attributes and chapter counts, complete cases only.

    ``tables`` holds the seven clinical roles: admissions, icu_stays,
    patients, diagnoses and the event tables named by the catalogue's
    sources (charts, labs, outputs). Where one of those sources carries the
    diagnosis codes itself, in ``icd9_code``, ``code_source`` names it and
    ``diagnoses`` is not read: counts and measures share one aggregate.
    """
    measures = subject_measures(
        {s: tables[s] for s in catalogue.sources()}, catalogue, item_col=item_col, complete=True,
        code_source=code_source,
    )
    cohort = stay_cohort(
        tables["admissions"], tables["icu_stays"], tables["patients"],
        None if code_source else tables["diagnoses"], subject_extra=measures,
    )
    return complete_cases(cohort)


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Named columns -> one ML vector column; a NULL input raises (M1)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def feature_vectors(
    features: DataFrame,
    task: str,
    catalogue: MeasureCatalogue = CLINICAL_CATALOGUE,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(``keep`` columns, features, label) for ``task`` in {"classification",
    "regression"}; the label is a double, as ``pyspark.ml`` expects.

    Rows reach this point from shuffles in no fixed order; each partition is
    sorted locally on every model input (rows equal on all of them are
    interchangeable), so a table written from here, and the seeded
    order-sensitive learners fed from it, are reproducible. No shuffle.
    """
    label = CLASSIFICATION_LABEL if task == "classification" else REGRESSION_LABEL
    cols = vector_columns(catalogue, task)
    rows = complete_cases(features, cols + [label]).sortWithinPartitions(*keep, label, *cols)
    vec = assemble(rows, cols)
    return vec.select(*keep, "features", F.col(label).cast("double").alias(label))


def vector_slots(df: DataFrame, col: str, n: int, prefix: str = "f") -> DataFrame:
    """Vector column -> ``n`` double columns (dense and sparse rows alike)."""
    arr = vector_to_array(F.col(col))
    return df.select(*[c for c in df.columns if c != col], *array_slots(arr, n, prefix))


def split_flag(
    df: DataFrame, key: str, train_percent: int = 70, salt: str = "", out: str = "is_train"
) -> DataFrame:
    """Add a reproducible train/test flag from a hash of ``key``.

    Every row of one key lands on the same side (no subject in both train and
    test); the split depends on nothing but the key, so it survives
    re-partitioning and recomputation after a lost executor.
    """
    return df.withColumn(out, key_bucket(F.col(key), 100, salt) < F.lit(train_percent))


def split_by_key(
    df: DataFrame, key: str, train_percent: int = 70, salt: str = ""
) -> tuple[DataFrame, DataFrame]:
    flagged = split_flag(df, key, train_percent, salt, "_is_train")
    train = flagged.filter(F.col("_is_train")).drop("_is_train")
    test = flagged.filter(~F.col("_is_train")).drop("_is_train")
    return train, test


def split_random(df: DataFrame, train_fraction: float = 0.7, seed: int = 42, out: str = "is_train") -> DataFrame:
    """Add a seeded random train/test flag (M2a), in one scan.

    The flag follows a row's place in its partition, so it is reproducible for
    a fixed input partitioning; use ``split_by_key`` when that cannot be
    guaranteed."""
    return df.withColumn(out, F.rand(seed) < F.lit(train_fraction))
