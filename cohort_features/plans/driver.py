"""The clinical roles expressed over the driver's test tables.

The operators are written against seven clinical roles (admissions, ICU
stays, patients, diagnoses, charts, labs, outputs). The test tables are a
TPC-H-like star schema plus an event stream, so each role is a projection
(sometimes a join) of them. Every mapping is a plain DataFrame expression,
so predicates and column pruning still reach the Parquet scans.

| role        | built from                  | subject     | item / key             | value                |
| ----------- | --------------------------- | ----------- | ---------------------- | -------------------- |
| admissions  | orders                      | o_custkey   | o_orderkey             | o_orderstatus = 'F'  |
| icu_stays   | lineitem                    | -           | l_orderkey             | l_quantity (LOS)     |
| patients    | customer                    | c_custkey   | -                      | derived birth date   |
| diagnoses   | lineitem x orders           | o_custkey   | code from l_partkey    | -                    |
| charts      | events                      | user_id     | event_type             | value                |
| labs        | lineitem x orders           | o_custkey   | returnflag+linestatus  | l_quantity as text   |
| outputs     | orders                      | o_custkey   | o_orderpriority        | o_totalprice as text |
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_features.functions.catalog import Component, Measure, MeasureCatalogue

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_OPEN: ContextVar[dict[str, DataFrame] | None] = ContextVar("open_tables", default=None)


def shared(query: Callable) -> Callable:
    """``query``, opening each table once however many roles read it: a
    relation costs a file listing and a footer read on the driver. Relations
    are shared within one call only, so a later one sees new files."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        token = _OPEN.set({})
        try:
            return query(spark, sf_dir)
        finally:
            _OPEN.reset(token)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table as a lazy relation."""
    path, opened = f"{sf_dir.rstrip('/')}/{name}.parquet", _OPEN.get()
    if opened is None:
        return spark.read.parquet(path)
    if path not in opened:
        opened[path] = spark.read.parquet(path)
    return opened[path]


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_orderdate").alias("admittime"),
        F.lit(None).cast("timestamp_ntz").alias("deathtime"),
        F.col("o_orderpriority").alias("diagnosis"),
        (F.col("o_orderstatus") == F.lit("F")).cast("int").alias("hospital_expire_flag"),
    )


def icu_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("hadm_id"), F.col("l_quantity").alias("los"))


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    born = F.date_add(F.lit("1900-01-01").cast("date"), F.pmod(F.col("c_custkey") * 37, F.lit(30000)).cast("int"))
    return c.select(
        F.col("c_custkey").alias("subject_id"),
        born.cast("timestamp_ntz").alias("dob"),
        F.substring("c_mktsegment", 1, 1).alias("gender"),
    )


def lines_by_subject(spark: SparkSession, sf_dir: str, cols: list[str]) -> DataFrame:
    """Line items with the subject (customer) of their order attached."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", *cols)
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("subject_id")
    )
    return li.join(o, on="l_orderkey", how="inner")


def diagnosis_code(partkey: F.Column, linenumber: F.Column) -> F.Column:
    """Synthetic code: partkey mod 1000 zero-padded to 3 digits, 'V' prefix on
    line 1, 'E' on line 2, NULL on line 7 (so every chapter branch, both
    gaps and the NULL drop are exercised)."""
    digits = F.lpad(F.pmod(partkey, F.lit(1000)).cast("string"), 3, "0")
    return (
        F.when(linenumber == 1, F.concat(F.lit("V"), digits))
        .when(linenumber == 2, F.concat(F.lit("E"), digits))
        .when(linenumber == 7, F.lit(None).cast("string"))
        .otherwise(digits)
    )


def diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lines_by_subject(spark, sf_dir, ["l_partkey", "l_linenumber"])
    return lines.select(
        "subject_id", diagnosis_code(F.col("l_partkey"), F.col("l_linenumber")).alias("icd9_code")
    )


def charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("subject_id"),
        F.col("event_type").alias("itemid"),
        F.col("value").cast("string").alias("value"),
        F.col("value").alias("valuenum"),
    )


def labs(spark: SparkSession, sf_dir: str, codes: bool = False) -> DataFrame:
    """``codes``: each lab row also carries its line's diagnosis code, so that
    one line x order join serves both roles."""
    cols = ["l_returnflag", "l_linestatus", "l_quantity"]
    lines = lines_by_subject(spark, sf_dir, cols + (["l_partkey", "l_linenumber"] if codes else []))
    code = [diagnosis_code(F.col("l_partkey"), F.col("l_linenumber")).alias("icd9_code")] if codes else []
    return lines.select(
        "subject_id",
        F.concat("l_returnflag", "l_linestatus").alias("itemid"),
        F.col("l_quantity").cast("string").alias("value"),
        *code,
    )


def outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderpriority").alias("itemid"),
        F.col("o_totalprice").cast("string").alias("value"),
    )


def clinical_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "admissions": admissions(spark, sf_dir),
        "icu_stays": icu_stays(spark, sf_dir),
        "patients": patients(spark, sf_dir),
        "diagnoses": diagnoses(spark, sf_dir),
        "charts": charts(spark, sf_dir),
        "labs": labs(spark, sf_dir, codes=True),
        "outputs": outputs(spark, sf_dir),
    }


# The clinical catalogue's shape (same families, kinds and flags) with item
# ids taken from the driver tables' vocabularies. The tables' amounts have two
# decimals (percentages of them four), which ``scale`` declares.
DRIVER_CATALOGUE = MeasureCatalogue(
    components=(
        Component("temp_f", "charts", ("click",), "valuenum", "f_to_c"),
        Component("temp_c", "charts", ("view",), "valuenum", scale=2),
        Component("heart_rate", "charts", ("purchase",), "valuenum", scale=2),
        Component("bp", "charts", ("signup", "purchase"), "valuenum", scale=2),
        Component("coma_scale", "charts", ("error",), "valuenum", scale=2),
        Component("fio2_fraction", "charts", ("signup",), "value", scale=2),
        Component("fio2_percent", "charts", ("click", "error"), "value", "percent", scale=4),
        Component("urine_output", "outputs", ("1-URGENT", "2-HIGH"), "value", scale=2),
        Component("nitrogen", "labs", ("AF",), "value", scale=2),
        Component("wbc", "labs", ("NO", "NF"), "value", scale=2),
        Component("bico", "labs", ("RF",), "value", scale=2),
        Component("sodium", "labs", ("RO", "AO"), "value", scale=2),
        Component("potassium", "labs", ("NF",), "value", scale=2),
        Component("bilirubin", "labs", ("AO",), "value", scale=2),
        Component("po2", "labs", ("RF", "RO"), "value", scale=2),
    ),
    measures=(
        Measure("avg_temp", "merge", ("temp_f", "temp_c")),
        Measure("avg_heart_rate", "mean", ("heart_rate",)),
        Measure("avg_bp", "mean", ("bp",)),
        Measure("avg_coma_scale", "mean", ("coma_scale",)),
        Measure("avg_urine_output", "mean", ("urine_output",)),
        Measure("avg_nitrogen", "mean", ("nitrogen",)),
        Measure("avg_wbc", "mean", ("wbc",)),
        Measure("avg_bico", "mean", ("bico",)),
        Measure("avg_sodium", "mean", ("sodium",)),
        Measure("avg_potassium", "mean", ("potassium",), in_vector=False),
        Measure("avg_bilirubin", "mean", ("bilirubin",)),
        Measure("avg_fio2", "merge", ("fio2_fraction", "fio2_percent"), visible=False),
        Measure("pf_ratio", "ratio", ("po2", "avg_fio2")),
    ),
)
