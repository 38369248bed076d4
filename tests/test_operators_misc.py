"""Smaller operators: bounded multisets, one-hot vocabulary, descriptions, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohort_features.functions.catalog import CLINICAL_CATALOGUE, vector_columns
from cohort_features.operators import cohort, describe, features


def test_collect_codes_is_bounded_by_vocabulary(spark):
    # key 0 holds a third of 30k rows, but only 4 distinct values
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("k"),
        F.concat(F.lit("c"), (F.col("id") % 4).cast("string")).alias("code"),
    ).unionByName(spark.createDataFrame([(0, None)], "k long, code string"))
    out = {r["k"]: r for r in cohort.collect_codes(df, "k", "code").collect()}
    hot = out[0]
    assert hot["codes"] == ["c0", "c1", "c2", "c3"]
    assert sum(hot["counts"]) == 10000  # NULL value skipped
    assert all(len(r["codes"]) <= 4 for r in out.values())


def test_one_hot_columns(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "id int, t string")
    out = describe.one_hot_columns(df, "t", ["a", "b"]).orderBy("id").collect()
    assert [(r["t_a"], r["t_b"]) for r in out] == [(0, 1), (1, 0), (0, 0), (0, 1)]


def test_one_hot_rows_set_no_limit_on_categories(spark):
    df = spark.range(1500).select("id", F.concat(F.lit("c"), F.col("id").cast("string")).alias("t"))
    out = describe.one_hot_rows(df.unionByName(spark.createDataFrame([(9999, None)], "id long, t string")), "id", "t")
    assert out.columns == ["id", "category", "value"]
    assert out.count() == out.select("category").distinct().count() == 1500


def test_descriptions_cover_every_vector_column(spark):
    d = {r["feature"] for r in describe.descriptions_frame(spark).collect()}
    for task in ("classification", "regression"):
        assert set(vector_columns(CLINICAL_CATALOGUE, task)) <= d


def test_describe_long_form(spark):
    wide = spark.createDataFrame([(1, 37.0, None), (2, 36.5, 80.0)], "subject_id long, avg_temp double, avg_heart_rate double")
    long_df = describe.long_form(wide, "subject_id", ["avg_temp", "avg_heart_rate"])
    got = sorted((r["subject_id"], r["feature"], r["description"]) for r in
                 describe.describe(long_df, describe.descriptions_frame(spark)).collect())
    assert got == [(1, "avg_temp", "Body Temperature"), (2, "avg_heart_rate", "Heart Rate"),
                   (2, "avg_temp", "Body Temperature")]


def test_split_random_seeded(spark):
    df = spark.range(5000)
    a = features.split_random(df, 0.7, seed=3).orderBy("id").collect()
    b = features.split_random(df, 0.7, seed=3).orderBy("id").collect()
    assert a == b and 0.66 < sum(r["is_train"] for r in a) / 5000 < 0.74


def test_code_counts_equal_collect_then_count(spark):
    """A4 equivalence: 20 count_if columns == collect each subject's chapter
    list, then count each chapter in the list (the literal form)."""
    from cohort_features.functions.catalog import CODE_COUNT_COLUMNS
    from cohort_features.functions.expressions import code_group
    from cohort_features.plans import driver
    from tests.conftest import SF_SMALL

    dx = driver.diagnoses(spark, SF_SMALL)
    ours = cohort.code_counts(dx)
    lists = dx.dropna(subset=["icd9_code"]).groupBy("subject_id").agg(
        F.collect_list(code_group("icd9_code")).alias("groups")
    )
    def equals(i):  # one-argument lambda: two arguments would mean (element, index)
        return lambda g: g == i

    literal = lists.select(
        "subject_id",
        *[F.size(F.filter("groups", equals(i))).cast("long").alias(c)
          for i, c in enumerate(CODE_COUNT_COLUMNS, start=1)],
    )
    assert ours.count() == literal.count() > 0
    assert ours.exceptAll(literal).count() == 0 and literal.exceptAll(ours).count() == 0
