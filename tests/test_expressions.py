"""Truth tables of the column builders (FIXTURES.md §3)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohort_features.functions import expressions as X

E1_CASES = {
    "001": 1, "139": 1, "140": 2, "239": 2, "240": 3, "279": 3, "280": 4, "289": 4,
    "290": 5, "319": 5, "320": 6, "389": 6, "390": 7, "459": 7, "460": 8, "519": 8,
    "520": 9, "579": 9, "580": 10, "629": 10, "630": 11, "679": 11, "680": 12, "709": 12,
    "710": 13, "739": 13, "740": 14, "759": 14, "780": 15, "789": 15, "790": 16, "796": 16,
    "797": 17, "799": 17, "800": 18, "999": 18, "V30": 19, "E84": 20,
    "000": None, "760": None, "779": None, "XYZ": None, "": None, None: None,
    "0389": 1, "25000": 3, "V3000": 19, "E8490": 20, "76519": None,
}


def test_code_group_truth_table(spark):
    df = spark.createDataFrame([(k,) for k in E1_CASES], "code string")
    got = {r["code"]: r["g"] for r in df.select("code", X.code_group("code").alias("g")).collect()}
    assert got == E1_CASES


def test_fahrenheit_to_celsius(spark):
    df = spark.createDataFrame([(32.0,), (98.6,), (0.0,), (None,)], "f double")
    got = [r[0] for r in df.select(F.round(X.fahrenheit_to_celsius("f"), 6)).collect()]
    assert got == [0.0, 37.0, None, None]


def test_merge_truthy(spark):
    cases = [((36.0, 38.0), 37.0), ((36.0, None), 36.0), ((None, 38.0), 38.0), ((0.0, 38.0), 38.0),
             ((36.0, 0.0), 36.0), ((0.0, None), None), ((None, 0.0), 0.0), ((None, None), None)]
    df = spark.createDataFrame([c[0] for c in cases], "a double, b double")
    got = [r[0] for r in df.select(X.merge_truthy("a", "b")).collect()]
    assert got == [c[1] for c in cases]


def test_age_years_edges(spark):
    rows = [
        (dt.datetime(2150, 3, 1), dt.datetime(2100, 3, 2), 49),   # day before birthday
        (dt.datetime(2150, 3, 2), dt.datetime(2100, 3, 2), 50),   # birthday
        (dt.datetime(2140, 2, 28), dt.datetime(2104, 2, 29), 35),  # leap-day birth
        (dt.datetime(2186, 1, 1), dt.datetime(2100, 1, 1), 86),
        (dt.datetime(2187, 1, 1), dt.datetime(2100, 1, 1), 87),
        (dt.datetime(2400, 1, 1), dt.datetime(2100, 1, 1), 87),   # 300 -> capped
        (None, dt.datetime(2100, 1, 1), None),
        (dt.datetime(2100, 1, 1), None, None),
    ]
    df = spark.createDataFrame(rows, "at timestamp, born timestamp, want int")
    for r in df.select(X.age_years("at", "born").alias("age"), "want").collect():
        assert r["age"] == r["want"]


def test_binary_code(spark):
    df = spark.createDataFrame([("M",), ("F",), (None,)], "g string")
    assert [r[0] for r in df.select(X.binary_code("g")).collect()] == [0, 1, 1]


def test_ratio_and_rounding(spark):
    df = spark.createDataFrame([(90.0, 0.5), (90.0, 0.0), (90.0, 0.004)], "a double, b double")
    got = [r[0] for r in df.select(X.safe_ratio("a", X.round_half_up("b", 2))).collect()]
    assert got == [180.0, None, None]


def test_safe_numeric(spark):
    df = spark.createDataFrame([("1.5",), ("ERROR",), ("<0.1",), (None,)], "v string")
    assert [r[0] for r in df.select(X.safe_numeric("v")).collect()] == [1.5, None, None, None]


def test_round_half_up_ties(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (1.005,), (2.5,), (1234.4999999999998,)], "x double")
    got = [r[0] for r in df.select(X.round_half_up("x", 2)).collect()]
    assert got[:3] == [0.13, -0.13, 1.01]
    got0 = [r[0] for r in df.select(X.round_half_up("x", 0)).collect()]
    assert got0[3:] == [3.0, 1234.0]


def test_declared_scale_means_are_exact(spark):
    # 10.1 and 12.2 average to 11.15 exactly; float sums would need luck
    df = spark.createDataFrame([(1, 10.1), (1, 12.2), (2, 0.125), (2, 0.0), (3, None)], "k int, v double")
    got = {r["k"]: r["m"] for r in df.groupBy("k").agg(X.mean("v", 3).alias("m")).collect()}
    assert got == {1: 11.15, 2: 0.0625, 3: None}


@pytest.mark.parametrize("value", [float("nan"), float("inf"), 1e30])
def test_values_beyond_a_declared_scale_raise(spark, value):
    df = spark.createDataFrame([(1, value), (1, 1.0)], "k int, v double")
    with pytest.raises(Exception, match="(?i)out_of_range|declared scale"):
        df.groupBy("k").agg(X.mean("v", 2)).collect()


def _means(spark, rows):
    """The same values through ``group_mean`` and ``subject_measures``."""
    df = spark.createDataFrame(rows, "subject_id int, v double").withColumn("itemid", F.lit(1))
    return _both(df)


def _both(df):
    from cohort_features.functions.catalog import Component, Measure, MeasureCatalogue
    from cohort_features.operators.measures import group_mean, subject_measures

    cat = MeasureCatalogue((Component("c", "s", (1,), "v"),), (Measure("m", "mean", ("c",), digits=None),))
    a = {r["subject_id"]: r["m"] for r in group_mean(df, "subject_id", "v", "m").collect()}
    b = {r["subject_id"]: r["m"] for r in subject_measures({"s": df}, cat).collect()}
    return a, b


def test_means_leave_no_value_out(spark):
    nan = float("nan")
    rows = [(1, 1e13), (1, 1.0), (2, nan), (2, 4.0), (3, 3e-7), (3, 4e-7), (4, float("inf")), (4, 1.0), (5, None), (5, 2.0)]
    for got in _means(spark, rows):
        assert got[1] == (1e13 + 1) / 2 and got[2] != got[2] and got[4] == float("inf") and got[5] == 2.0
        assert abs(got[3] - 3.5e-7) < 1e-20


def test_sums_of_many_large_values(spark):
    df = spark.range(2_000_000).select(F.lit(1).alias("subject_id"), F.lit(9e12).alias("v"), F.lit(1).alias("itemid"))
    assert _both(df) == ({1: 9e12}, {1: 9e12})
    exact = df.groupBy("subject_id").agg(X.mean("v", 6).alias("m")).first()["m"]
    assert exact == 9e12


def test_short_arrays_give_nulls(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([],), (None,)], "a array<double>")
    got = [tuple(r) for r in df.select(*X.array_slots("a", 3, "e")).collect()]
    assert got == [(1.0, 2.0, None), (None,) * 3, (None,) * 3]


def test_key_bucket_is_stable(spark):
    df = spark.range(1000).select(F.col("id"), X.key_bucket("id", 100).alias("b"))
    a = df.collect()
    b = df.repartition(7).orderBy("id").collect()
    assert a == b
    assert all(0 <= r["b"] < 100 for r in a)


def test_cluster_conf_sizes_partitions():
    from cohort_features.session import cluster_conf

    conf = cluster_conf(3 * 1024**4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 24576
    small = cluster_conf(10 * 1024**2, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 192  # three waves of cores
