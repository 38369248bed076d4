"""Readers and writers: typed CSV scans, CSV -> Parquet ingest, feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohort_features.sources.schemas import CLINICAL_SCHEMAS


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> DataFrame:
    """CSV with a header row, typed by an explicit schema.

    Columns are bound by header name (case-insensitive), so the files may
    carry extra columns in any order; only the schema's columns are kept. All
    files of ``path`` must have the same header: one that differs fails the
    query rather than being read under another file's names. Every field is
    read as text and converted with ``try_cast``: no inference pass over the
    data, and a malformed field becomes NULL instead of failing the task under
    ANSI mode.
    """
    if not header:
        return spark.read.schema(schema).option("mode", "PERMISSIVE").csv(path)
    names = spark.read.option("header", True).option("inferSchema", False).csv(path).schema
    raw = spark.read.schema(names).option("header", True).option("enforceSchema", False).csv(path)
    return raw.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """Parquet (self-describing) or CSV (needs ``schema``)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "csv":
        if schema is None:
            raise ValueError("CSV input needs an explicit schema")
        return read_csv(spark, path, schema)
    raise ValueError(f"unsupported format {fmt!r}")


def read_clinical(spark: SparkSession, paths: dict[str, str], fmt: str = "csv") -> dict[str, DataFrame]:
    """The seven clinical roles from ``{role: path}`` with their schemas."""
    return {role: read_table(spark, p, fmt, CLINICAL_SCHEMAS[role]) for role, p in paths.items()}


def ingest_csv(
    spark: SparkSession,
    csv_path: str,
    schema: StructType,
    parquet_path: str,
    partition_by: list[str] | None = None,
    sort_within: list[str] | None = None,
) -> DataFrame:
    """One-time CSV -> Parquet conversion.

    Later scans then read only the columns they use, skip row groups by
    min/max statistics (``sort_within`` on the filter column, e.g. ``itemid``,
    makes those statistics selective) and never re-parse text.
    """
    df = read_csv(spark, csv_path, schema)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(parquet_path)
    return spark.read.parquet(parquet_path)


def write_features(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Persist a feature table (vector column included) as Parquet."""
    df.write.mode(mode).parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Read a feature table back with its vector column typed."""
    return spark.read.parquet(path)
