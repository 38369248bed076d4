"""Model operators: determinism, persistence, sanity, grids and CV."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
import numpy as np
import pytest
import pickle
import random
import os

from pyspark.sql import functions as F

from cohort_features.operators import boosting, tuning
from cohort_features.operators import metrics, models, scoring


def _separable(spark, n=400):
    # label = 1 when x0 + x1 > 1; x2 is noise, x3 sometimes negative
    df = spark.range(n).select(
        F.col("id"),
        ((F.col("id") * 37 % 100) / 100.0).alias("x0"),
        ((F.col("id") * 91 % 100) / 100.0).alias("x1"),
        ((F.col("id") * 13 % 7) / 7.0).alias("x2"),
        ((F.col("id") * 17 % 11) / 11.0 - 0.5).alias("x3"),
    )
    return df.withColumn("label", ((F.col("x0") + F.col("x1")) > 1).cast("double")).withColumn(
        "y", F.col("x0") * 3 + F.col("x1") * 2 + F.col("x2")
    )


def _vectors(spark):
    from cohort_features.operators.features import assemble, split_by_key

    df = assemble(_separable(spark), ["x0", "x1", "x2", "x3"])
    return split_by_key(df, "id", 70)


def test_seeded_fit_is_reproducible(spark):
    train, test = _vectors(spark)
    a = models.fit_and_score(models.classifier("random_forest", "label", 4), train, test,
                             "classification", "label", "rf")
    b = models.fit_and_score(models.classifier("random_forest", "label", 4), train, test,
                             "classification", "label", "rf")
    assert a == b


def test_classifiers_beat_constant(spark):
    train, test = _vectors(spark)
    base = max(test.agg(F.avg("label")).first()[0], 1 - test.agg(F.avg("label")).first()[0])
    for name in ("logistic_regression", "decision_tree", "gbt"):
        model = models.classifier(name, "label", 4, maxIter=10) if name != "decision_tree" else \
            models.classifier(name, "label", 4)
        acc = metrics.accuracy(model.fit(train).transform(test), "label").first()["accuracy"]
        assert acc > base, name


def test_naive_bayes_accepts_negative_features(spark):
    train, test = _vectors(spark)
    # x3 is negative for some rows: scaling + clamping keeps the model valid
    rows = models.fit_and_score(models.classifier("naive_bayes", "label", 4), train, test,
                                "classification", "label", "nb")
    assert {r[1] for r in rows} == {"accuracy"}


def test_bake_off_rows(spark):
    train, test = _vectors(spark)
    ests = {n: models.regressor(n, "y") for n in ("linear", "decision_tree")}
    out = models.bake_off(spark, ests, train, test, "regression", "y").collect()
    sides = {("data", f"{s}_{k}") for s in ("train", "test") for k in ("rows", "label_mean")}
    assert {(r["model"], r["metric"]) for r in out} == {(m, k) for m in ests for k in ("rmse", "mae", "r2")} | sides
    data = {r["metric"]: r["value"] for r in out if r["model"] == "data"}
    assert (data["train_rows"], data["test_rows"]) == (train.count(), test.count())
    lin = {r["metric"]: r["value"] for r in out if r["model"] == "linear"}
    assert lin["r2"] > 0.9


def test_pipeline_save_load_same_predictions(spark, scratch):
    df = _separable(spark)
    model = scoring.fit_pipeline(df, ["x0", "x1", "x2"], models.regressor("gbt", "y", maxIter=5))
    path = os.path.join(scratch, "pipe")
    scoring.save_pipeline(model, path)
    a = scoring.score_batch(model, df, ["id"]).orderBy("id").collect()
    b = scoring.score_batch(scoring.load_pipeline(path), df, ["id"]).orderBy("id").collect()
    assert a == b


def test_reference_grids_as_rows(spark):
    rows = models.param_grid_frame(spark, models.REFERENCE_GRIDS).collect()
    assert len(rows) == 36  # 2 grids x 9 points x 2 params
    clf = {(r["point"], r["param"]): r["value"] for r in rows if r["grid"] == "gbt_classifier"}
    assert sorted({v for (p, k), v in clf.items() if k == "maxDepth"}) == [11.0, 12.0, 13.0]
    assert sorted({v for (p, k), v in clf.items() if k == "maxIter"}) == [20.0, 25.0, 30.0]


def test_cross_validate_with_key_folds(spark):
    train, test = _vectors(spark)
    est = models.classifier("decision_tree", "label", 4)
    out = models.cross_validate(spark, est, {"maxDepth": [2, 4]}, train, test,
                                "classification", "label", folds=2, fold_key="id").collect()
    assert sum(1 for r in out if r["metric"] == "cv_accuracy") == 2
    assert any(r["model"] == "best" and r["metric"] == "accuracy" for r in out)


def test_rounds_of_one_fit_equal_separate_fits(spark):
    train, test = _vectors(spark)
    fast = [r for r in tuning.cross_validate_rounds(spark, "regression", [2, 3], [2, 4], train, test, "y", folds=2, fold_key="id").collect() if not r["metric"].startswith("max")]
    slow = models.cross_validate(spark, models.regressor("gbt", "y"), {"maxDepth": [2, 3], "maxIter": [2, 4]}, train, test,
                                 "regression", "y", folds=2, fold_key="id").collect()
    cv = {r["model"]: r["value"] for r in fast if r["metric"] == "cv_rmse"}
    maps = models.param_grid(models.regressor("gbt", "y"), {"maxDepth": [2, 3], "maxIter": [2, 4]})
    order = {f"point{i}": tuple(v for _, v in sorted((p.name, v) for p, v in m.items())) for i, m in enumerate(maps)}
    points = {(d, r): cv[f"point{i}"] for i, (d, r) in enumerate((d, r) for d in (2, 3) for r in (2, 4))}
    for r in slow:
        if r["metric"] == "cv_rmse":
            assert abs(points[order[r["model"]]] - r["value"]) < 1e-9


def test_staged_classifier_scores_equal_fitting_every_point(spark):
    rng = random.Random(5)
    rows = [(i, float(rng.random()), float(rng.random()), 0) for i in range(400)]
    rows = [(i, a, b, int((a > 0.5) != (b > 0.4)) if rng.random() < 0.85 else int(rng.random() < 0.5)) for i, a, b, _ in rows]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int").withColumn("y", F.col("y").cast("double"))
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    train, test = vec.filter("id % 4 <> 0"), vec.filter("id % 4 = 0")
    fast = {(r["model"], r["metric"]): r["value"] for r in tuning.cross_validate_rounds(spark, "classification", [2, 4], [1, 3, 5], train, test, "y", folds=3, fold_key="id").collect()}
    est = tuning.estimator("classification", "y", 2, 1, 42)
    slow = models.cross_validate(spark, est, {"maxDepth": [2, 4], "maxIter": [1, 3, 5]}, train, test, "classification", "y", folds=3, fold_key="id").collect()
    for r in slow:
        assert fast[r["model"], r["metric"]] == pytest.approx(r["value"], abs=1e-12)
    assert fast["best", "maxDepth"] in (2, 4) and fast["best", "maxIter"] in (1, 3, 5)


def test_training_side_has_the_partitions_its_rows_need(spark, monkeypatch):
    from cohort_features.plans import queries

    rows = [(i, i % 40, float(i % 7), float(i % 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, subject_id long, x double, expire_flag double").repartition(20)
    vec = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    monkeypatch.setattr(queries, "stay_features", lambda spark, sf_dir: df)
    monkeypatch.setattr(queries.feature_ops, "feature_vectors", lambda *args, **kw: vec)
    monkeypatch.setattr(tuning, "TASK_ROWS", 100)
    train, test = queries._training_sets(spark, "", "classification")
    assert train.rdd.getNumPartitions() == -(-train.count() // 100) < 20
    assert train.count() + test.count() == 400
    queries._done(train, None)


def test_staged_grid_equals_every_fit(spark):
    train, test = _vectors(spark)
    est = models.classifier("gbt", "label", 4, stepSize=0.3)
    args = spark, est, {"maxDepth": [2, 3], "maxIter": [2, 4]}, train, test, "classification", "label", 2, 42, 4, "id"
    rows = [{(r["model"], r["metric"]): r["value"] for r in models.cross_validate(*args, staged=staged).collect()} for staged in (True, False)]
    assert rows[0].keys() == rows[1].keys() and all(abs(rows[0][k] - v) < 1e-12 for k, v in rows[1].items())


def test_grid_search_leaves_no_table_in_memory(spark):
    train, test = _vectors(spark)
    train = train.repartition(6).localCheckpoint()
    before = spark._jsparkSession.sharedState().cacheManager().numCachedEntries()
    tuning.cross_validate_rounds(spark, "regression", [2], [1], train, test, "y", folds=2, fold_key="id")
    assert spark._jsparkSession.sharedState().cacheManager().numCachedEntries() == before


def test_both_deployed_models_learn_side_by_side_from_few_partitions(spark, monkeypatch):
    from cohort_features.plans import queries

    class Stop(Exception):
        pass

    seen = []
    df = spark.createDataFrame([(i, i) for i in range(400)], "subject_id long, hadm_id long").repartition(20)
    monkeypatch.setattr(queries, "stay_features", lambda spark, sf_dir: df)
    monkeypatch.setattr(queries.scoring_ops, "fit_pipeline", lambda train, cols, est: seen.append(train.rdd.getNumPartitions()))

    def stop(*args):
        raise Stop

    monkeypatch.setattr(queries.scoring_ops, "reloaded", stop)
    with pytest.raises(Stop):
        queries.score_batch(spark, "")
    df.unpersist()
    assert seen == [1, 1]


def _stays(spark, n=600, parts=4, seed=3):
    """Subjects of three stays with the same features, labels of their own."""
    rng = random.Random(seed)
    x = [[rng.random(), rng.random(), float(rng.randrange(5)), 0.0] for _ in range(n // 3 + 1)]
    rows = [(i // 3, *x[i // 3], 3 * x[i // 3][0] + x[i // 3][1] ** 2 + x[i // 3][2] + rng.gauss(0, 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double").repartition(parts, "id")
    vec = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)
    return vec.filter("id % 4 <> 0"), vec.filter("id % 4 = 0")


def _grid(spark, train, test, depths, rounds, folds=3, **kw):
    found = tuning.cross_validate_rounds(spark, "regression", depths, rounds, train, test, "y", folds=folds, fold_key="id", **kw).collect()
    return {(r["model"], r["metric"]): r["value"] for r in found}


def test_regression_grid_takes_a_job_per_level_for_all_fits(spark):
    train, test = _stays(spark)
    sc = spark.sparkContext
    sc.setJobGroup("grid-jobs", "")
    try:
        _grid(spark, train, test, [2, 4], [3, 6], folds=5)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = len(sc.statusTracker().getJobIdsForGroup("grid-jobs"))
    assert 6 <= jobs <= 6 * 4 + 30  # ten fits one by one: 6 rounds of 2 or 4 levels each, 180 jobs


@pytest.mark.parametrize("near", [0, 1 << 30])
@pytest.mark.parametrize("size", [50_000, 40])
def test_regression_grid_equals_every_fit_on_merged_and_single_rows(spark, monkeypatch, size, near):
    train, test = _stays(spark, n=2400)  # nodes large enough that no two features split one alike
    monkeypatch.setattr(boosting, "ROWS", size)
    monkeypatch.setattr(boosting, "NEAR", near)
    fast = _grid(spark, train, test, [2, 3], [2, 5])
    args = spark, models.regressor("gbt", "y"), {"maxDepth": [2, 3], "maxIter": [2, 5]}, train, test, "regression", "y"
    for r in models.cross_validate(*args, folds=3, fold_key="id").collect():
        assert fast[r["model"], r["metric"]] == pytest.approx(r["value"], abs=1e-9)


def test_rows_of_a_key_with_the_same_bins_become_one(spark, monkeypatch):
    train, _ = _stays(spark)
    cuts = [np.array([0.5]), np.array([0.5]), np.array([1.5]), np.empty(0)]
    held = train.withColumn("_fold", F.lit(0))
    kept = {m: [pickle.loads(r["block"]) for r in boosting.blocks(held, "y", "features", "id", {-1: cuts}, m).collect()] for m in (True, False)}
    n, s = ({m: np.concatenate([b[i] for b in blocks]) for m, blocks in kept.items()} for i in (2, 3))
    assert len(n[False]) == train.count() and len(n[True]) == train.select("id").distinct().count()
    assert n[True].sum() == len(n[False]) and s[True].sum() == pytest.approx(s[False].sum())


def test_split_candidates_come_from_the_sample_of_a_single_fit(spark):
    train, _ = _stays(spark, n=16_400)
    est = tuning.estimator("regression", "y", 4, 4, 42)
    model = est.fit(train)
    cuts = boosting.candidates(train, "features", train.count(), boosting.rules(est, train, "y"))

    def splits(node):
        if node.numDescendants():
            yield node.split().featureIndex(), node.split().threshold()
            yield from splits(node.leftChild())
            yield from splits(node.rightChild())

    found = [s for t in model.trees for s in splits(t._call_java("rootNode"))]
    assert train.count() > 10_000 and len(found) > 20
    assert all(any(threshold == c for c in cuts[f]) for f, threshold in found)


def test_other_estimators_keep_their_own_fits(spark):
    train, _ = _stays(spark, n=30)
    assert boosting.rules(models.regressor("gbt", "y"), train, "y")
    for est in (models.regressor("gbt", "y", subsamplingRate=0.5), models.regressor("gbt", "y", lossType="absolute"), models.regressor("gbt", "y", weightCol="a"),
                models.regressor("gbt", "z"), models.regressor("random_forest", "y"), models.classifier("gbt", "y", 0)):
        assert boosting.rules(est, train, "y") is None


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf")])
def test_regression_grid_refuses_labels_that_are_no_numbers(spark, bad):
    train, test = _stays(spark, n=60)
    train = train.withColumn("y", F.when(F.col("id") == 1, F.lit(bad).cast("double")).otherwise(F.col("y")))
    with pytest.raises(Exception, match="labels must not be"):
        _grid(spark, train, test, [2], [1])
