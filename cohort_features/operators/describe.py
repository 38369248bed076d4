"""Feature descriptions and one-hot columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_features.functions.catalog import feature_descriptions
from cohort_features.functions.expressions import one_hot


def descriptions_frame(spark: SparkSession, rows: list[tuple[str, str]] | None = None) -> DataFrame:
    """The (feature, description) dimension: a fixed, small table."""
    return spark.createDataFrame(rows or feature_descriptions(), "feature string, description string")


def long_form(df: DataFrame, key: str | list[str], cols: list[str]) -> DataFrame:
    """Wide feature columns -> (key, feature, value) rows, NULL values dropped."""
    keys = [key] if isinstance(key, str) else list(key)
    out = df.unpivot(keys, cols, "feature", "value")
    return out.filter(F.col("value").isNotNull())


def describe(long_df: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Attach a description to every long-form feature row.

    The dimension has one row per known feature, so Spark broadcasts it by its
    size; a caller's larger dimension is shuffled.
    """
    return long_df.join(descriptions, on="feature", how="inner")


def one_hot_rows(df: DataFrame, key: str | list[str], col: str) -> DataFrame:
    """One-hot encoding in sparse form: (key, category, value 1) for every
    non-NULL value of ``col``; all other categories of a row are 0.

    No vocabulary is collected and no limit set on it: the table has one row
    per input row however many categories there are. ``one_hot_columns`` gives
    the wide form for categories the caller names.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return df.where(F.col(col).isNotNull()).select(*keys, F.col(col).alias("category"), F.lit(1).alias("value"))


def one_hot_columns(df: DataFrame, col: str, categories: list, prefix: str | None = None) -> DataFrame:
    """Add one 0/1 column per named category of ``col``."""
    return df.select("*", *one_hot(F.col(col), categories, prefix if prefix is not None else f"{col}_"))
