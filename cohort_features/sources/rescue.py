"""Malformed CSV fields: counted while the data is read, and kept aside.

``read_csv`` turns a field that has no value of its type into NULL. Here the
same scan counts such fields per column with an ``Observation`` (no pass of
its own), and ``rescued_fields`` gives them as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _raw(spark: SparkSession, path: str) -> DataFrame:
    names = spark.read.option("header", True).option("inferSchema", False).csv(path).schema
    return spark.read.schema(names).option("header", True).option("enforceSchema", False).csv(path)


def _malformed(name: str, dtype) -> Column:
    return F.col(name).isNotNull() & F.col(name).try_cast(dtype).isNull()


def read_csv_observed(spark: SparkSession, path: str, schema: StructType, name: str = "malformed") -> tuple[DataFrame, Observation]:
    """As ``readers.read_csv``, and an observation that holds the count of
    malformed fields of each column once an action has read the table."""
    seen = Observation(name)
    rows = _raw(spark, path)
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(_malformed(f.name, f.dataType)).alias(f.name) for f in schema.fields])
    return counted.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]), seen


def rescued_fields(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """One row per malformed field: ``key`` (as text), column, text. Rows
    without one cost no more than the scan."""
    rows = _raw(spark, path)
    bad = [F.when(_malformed(f.name, f.dataType), F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("text"))) for f in schema.fields]
    found = rows.select(F.col(key).alias("key"), F.filter(F.array(*bad), lambda x: x.isNotNull()).alias("bad"))
    return found.select("key", F.explode("bad").alias("b")).select("key", "b.column", "b.text")
