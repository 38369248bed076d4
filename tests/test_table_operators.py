"""Running totals, vocabularies, exact splits, aggregate models, mergeable
state and rescued fields against plain versions."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from cohort_features.operators import aggregate_models, ranks, splits, state
from cohort_features.operators.measures import subject_measures
from cohort_features.plans import driver
from cohort_features.plans.queries import STATE_CATALOGUE
from cohort_features.sources import rescue
from cohort_features.sources.readers import read_csv
from tests.conftest import SF_SMALL


def test_running_totals_are_a_loops(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), i, rng.randrange(9)) for i in range(500)]
    rng.shuffle(rows)
    got = ranks.running_totals(spark.createDataFrame(rows, "g string, i long, x long"), ["i"], {"s": F.col("x"), "c": F.lit(1)}, ["g"])
    sums, counts, want = defaultdict(int), defaultdict(int), set()
    for g, i, x in sorted(rows, key=lambda r: r[1]):
        sums[g] += x
        counts[g] += 1
        want.add((g, i, x, sums[g], counts[g]))
    assert {tuple(r) for r in got.collect()} == want


def test_one_hot_over_the_columns_own_values(spark):
    rows = [(i, v) for i, v in enumerate(["b", "a", None, "c", "a", "é", "Z"])]
    got = ranks.one_hot_vectors(spark.createDataFrame(rows, "id long, v string"), ["id"], "v")
    out = {r["id"]: (r["category"], r["index"], r["size"], r["cells"]) for r in got.withColumn("cells", vector_to_array("vector")).collect()}
    words = ["Z", "a", "b", "c", "é"]
    assert out == {i: (v, words.index(v), 5, [float(w == v) for w in words]) for i, v in rows if v}
    assert ranks.one_hot_vectors(spark.createDataFrame([], "id long, v string"), ["id"], "v").count() == 0


def test_a_split_is_exact_and_the_same_on_every_layout(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(5), rng.choice(["x", None, "y"])) for _ in range(3000)] + [(7, "hot")] * 9000
    sides = []
    for parts in (1, 200):
        table = spark.createDataFrame(rows, "a long, b string").repartition(parts)
        sides.append(Counter(tuple(r) for r in splits.split_exact(table, [0.5, 0.3, 0.2], seed=3).collect()))
    assert sides[0] == sides[1]
    by_side, by_row = Counter(), Counter()
    for (*row, side), n in sides[0].items():
        by_side[side] += n
        by_row[tuple(row)] += n
    assert by_side == {0: 6000, 1: 3600, 2: 2400} and by_row == Counter(rows)
    assert splits.split_exact(spark.createDataFrame([], "a long"), [0.7, 0.3]).count() == 0
    assert [r["side"] for r in splits.split_exact(spark.createDataFrame([(1,)], "a long"), [0.0, 1.0]).collect()] == [1]


def _labelled(spark, n=600):
    rng = random.Random(3)
    rows = [(float(rng.randrange(2)), float(rng.randrange(6)), rng.randrange(40) / 4, float(rng.randrange(3))) for _ in range(n)]
    rows = [(float(b + c > 7) if rng.random() < 0.9 else a, b, c, d) for a, b, c, d in rows]
    return spark.createDataFrame(rows, "y double, f0 double, f1 double, f2 double")


def test_bayes_by_sums_is_the_librarys(spark):
    df, names = _labelled(spark), ["f0", "f1", "f2"]
    table = aggregate_models.naive_bayes_table(df, "y", names)
    cells = {(r["class"], r["feature"]): r["log_probability"] for r in table.collect()}
    vec = VectorAssembler(inputCols=names, outputCol="features").transform(df)
    model = NaiveBayes(labelCol="y", smoothing=1.0, modelType="multinomial").fit(vec)
    for c in (0, 1):
        assert cells[float(c), "(prior)"] == pytest.approx(model.pi[c], abs=1e-9)
        for j, f in enumerate(names):
            assert cells[float(c), f] == pytest.approx(model.theta[c, j], abs=1e-9)
    both = aggregate_models.naive_bayes_predict(vec.drop("prediction"), table, names).withColumnRenamed("prediction", "mine")
    assert model.transform(both).filter("mine <> prediction").count() == 0


def test_the_first_split_is_a_stumps(spark):
    df, names = _labelled(spark), ["f0", "f1", "f2"]
    best = {r["feature"]: r for r in aggregate_models.best_splits(df, "y", names).collect()}
    for f in names:
        vec = VectorAssembler(inputCols=[f], outputCol="features").transform(df)
        stump = DecisionTreeClassifier(labelCol="y", maxDepth=1, maxBins=64).fit(vec)
        if stump.numNodes == 1:  # both leaves would say the same class, and the library prunes them
            assert f == "f2"
            continue
        cut = float(stump.toDebugString.split("<= ")[1].split(")")[0])
        assert best[f]["n_left"] == df.filter(F.col(f) <= cut).count() and best[f]["n_left"] + best[f]["n_right"] == 600
    assert aggregate_models.best_splits(df.withColumn("f0", F.lit(1.0)), "y", ["f0"]).count() == 0


def test_merged_state_is_one_pass_bit_for_bit(spark):
    events, comps = driver.charts(spark, SF_SMALL), STATE_CATALOGUE.components
    want = sorted(map(tuple, subject_measures({"charts": events}, STATE_CATALOGUE).collect()))
    for k in (1, 4, 9):
        parts = [state.batch_state(events.filter(F.pmod(F.crc32(F.col("value")), F.lit(k)) == i), comps) for i in range(k)]
        merged = state.merge_states([state.merge_states(parts[: k // 2 + 1], comps), *parts[k // 2 + 1 :]], comps)
        assert sorted(map(tuple, state.measures_of_state(merged, STATE_CATALOGUE).collect())) == want


def test_malformed_fields_are_counted_and_kept(spark, scratch):
    path = scratch + "/in"
    rows = [("1", "2.5", "x"), ("two", "n/a", "y"), (None, "3", "z"), ("4", "", "w")]
    spark.createDataFrame(rows, "id string, v string, k string").coalesce(1).write.option("header", True).csv(path)
    schema = StructType([StructField("id", LongType()), StructField("v", DoubleType())])
    df, seen = rescue.read_csv_observed(spark, path, schema)
    assert sorted(map(str, df.collect())) == sorted(map(str, read_csv(spark, path, schema).collect()))
    assert seen.get == {"rows": 4, "id": 1, "v": 1}
    assert {tuple(r) for r in rescue.rescued_fields(spark, path, schema, "k").collect()} == {("y", "id", "two"), ("y", "v", "n/a")}
