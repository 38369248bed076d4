"""Grid search of boosted trees by staged scores, fits side by side.

Boosting adds one tree after another, so a fit with the most rounds holds
every shorter one as a prefix. Per fold and depth one model is fitted and
scored after each of the grid's rounds: the values of fitting every grid point,
with 1/len(rounds) of the fits. Plain ``GBTRegressor``s learn together, a job per
level of a round for all of them (``boosting``). Other fits are independent
jobs over one persisted table and run side by side in a bounded pool of driver
threads, so that one fit's small jobs fill the cores that another's leave idle.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_features.functions.expressions import key_bucket
from cohort_features.operators import boosting
from cohort_features.operators.models import METRIC_SCHEMA, REFERENCE_FOLDS, classifier, evaluate, regressor

#: fits at a time, and rows of a training table that one task takes
PARALLEL, TASK_ROWS = 8, 50_000


def side_by_side(spark: SparkSession, work: Iterable[Callable], parallel: int = PARALLEL) -> list:
    """Results of independent pieces of driver work, in order. The pool is
    bounded; each thread carries the session's local properties (job group,
    scheduler pool) to its jobs."""
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(w)) for w in work]]


def training_rows(df: DataFrame) -> DataFrame:
    """``df``, which should be persisted, in as many partitions as its rows need:
    a fit runs a job per tree level whose every task fills, sends and merges
    the statistics of all the level's nodes, however few rows it has."""
    parts = max(1, -(-df.count() // TASK_ROWS))
    return df.coalesce(parts) if parts < df.rdd.getNumPartitions() else df


def estimator(task: str, label: str, depth: int, rounds: int, seed: int):
    make = classifier if task == "classification" else regressor
    extra = {"n_features": 0} if task == "classification" else {}
    return make("gbt", label, seed=seed, maxDepth=depth, maxIter=rounds, maxMemoryInMB=1024, **extra)


def staged_margins(model, df: DataFrame, rounds: list[int], label: str) -> DataFrame:
    """(label, m<r> for each r): the weighted sum of the first r trees. One
    pass, by the trees' own transformers."""
    out = df.select(F.col(label).alias("label"), "features")
    for i, tree in enumerate(model.trees[: max(rounds)]):
        out = tree.setPredictionCol(f"t{i}").transform(out)
    total, margins = F.lit(0.0), {}
    for i, weight in enumerate(model.treeWeights[: max(rounds)]):
        total = total + F.lit(float(weight)) * F.col(f"t{i}")
        margins[i + 1] = total
    return out.select("label", *[margins[r].alias(f"m{r}") for r in rounds])


def staged_scores(model, df: DataFrame, rounds: list[int], task: str, label: str) -> list[float]:
    """Accuracy (classification) or RMSE (regression) after each of ``rounds``."""
    if task == "classification":
        right = [F.avg(((F.col(f"m{r}") > 0).cast("double") == F.col("label")).cast("double")) for r in rounds]
        return list(staged_margins(model, df, rounds, label).agg(*[x.alias(f"a{r}") for x, r in zip(right, rounds, strict=True)]).first())
    mse = model.evaluateEachIteration(df, "squared")
    return [math.sqrt(mse[r - 1]) for r in rounds]


def fits_together(held: DataFrame, est: Estimator, plain: boosting.Rules, depths: list[int], rounds: list[int], sizes: dict, used: list[int], key: str) -> tuple[dict, Callable]:
    """({(depth, fold): RMSE after each of ``rounds``}, the predictions of a
    DataFrame's rows by the first n trees of a depth's fit over all of ``held``),
    by trees that learn together. ``_fold`` says each row's fold."""
    spark, label, features = held.sparkSession, est.getLabelCol(), est.getFeaturesCol()
    total, placed = sum(sizes.values()), sum(n for k, n in sizes.items() if k is not None)
    learn = {k: (held.filter(F.col("_fold") != k), placed - sizes[k]) for k in used} | {-1: (held, total)}
    cuts = side_by_side(spark, [functools.partial(boosting.candidates, rows, features, n, plain) for rows, n in learn.values()])
    sets = dict(zip(learn, cuts, strict=True))
    cut = boosting.blocks(held, label, features, key, sets, total > boosting.ROWS).persist(StorageLevel.MEMORY_AND_DISK)
    found: dict[tuple, list[float]] = {(d, k): [] for d in depths for k in used}
    try:
        fits = boosting.Boost(cut, sets, depths, plain)
        try:
            errors = {}
            for n in range(1, max(rounds) + 1):
                fits.round()
                if n in rounds:
                    errors[n] = fits.errors()
        finally:
            fits.close()
    finally:
        cut.unpersist()
    for (d, k), scores in found.items():
        scores += [math.sqrt(errors[n][k, d] / sizes[k]) for n in rounds]
    return found, lambda df, depth, n: boosting.predictions(df, label, features, sets[-1], fits.trees[-1, depth][:n], plain.step)


def cross_validate_rounds(
    spark: SparkSession,
    task: str,
    depths: list[int],
    rounds: list[int],
    train: DataFrame,
    test: DataFrame,
    label: str,
    folds: int = REFERENCE_FOLDS,
    fold_key: str = "subject_id",
    seed: int = 42,
    parallel: int = PARALLEL,
    make: Callable[[int, int], Estimator] | None = None,
) -> DataFrame:
    """k-fold CV of a boosted model over depth x rounds, by accuracy or RMSE;
    the best point is refitted on all of ``train`` and scored on ``test``.
    Rows (model, metric, value): ``cv_<metric>`` of each point (``point<i>``,
    in the order depth, then rounds) and the held-out metrics of ``best``.
    Folds are hashes of ``fold_key``, so an entity lies in one. A fold without
    rows is left out of the means; ties go to the first point. ``make`` gives the
    estimator of a depth and rounds."""
    make = make or (lambda depth, n: estimator(task, label, depth, n, seed))
    fold = key_bucket(F.col(fold_key), folds, "fold").cast("int")
    stored = train.withColumn("_fold", fold).persist(StorageLevel.MEMORY_AND_DISK)
    held = training_rows(stored)
    sizes = {r["_fold"]: r["count"] for r in held.groupBy("_fold").count().collect()}
    used = [k for k in range(folds) if sizes.get(k) and sum(sizes.values()) > sizes[k]]
    points = [(d, r) for d in depths for r in rounds]

    def work(depth: int, k: int) -> Callable[[], list[float]]:
        def run() -> list[float]:
            model = make(depth, max(rounds)).fit(held.filter(F.col("_fold") != k))
            return staged_scores(model, held.filter(F.col("_fold") == k), rounds, task, label)

        return run

    est = make(depths[0], max(rounds))
    plain = boosting.rules(est, held, label) if task == "regression" else None
    try:
        if plain:
            found, refitted = fits_together(held, est, plain, depths, rounds, sizes, used, fold_key)
        else:
            tasks = [(d, k) for d in sorted(depths, reverse=True) for k in used]  # the longest first
            found = dict(zip(tasks, side_by_side(spark, [work(*t) for t in tasks], parallel), strict=True))
        means = {(d, r): sum(found[d, k][i] for k in used) / len(used) for d in depths for i, r in enumerate(rounds)}
        better = max if task == "classification" else min
        depth, n = better(points, key=lambda p: means[p])
        predicted = refitted(test, depth, n) if plain else make(depth, n).fit(held).transform(test)
        held_out = evaluate(predicted, task, label)
    finally:
        stored.unpersist()
    metric = "cv_accuracy" if task == "classification" else "cv_rmse"
    rows = [(f"point{i}", metric, float(means[p])) for i, p in enumerate(points)]
    rows += [("best", "maxDepth", float(depth)), ("best", "maxIter", float(n))]
    rows += [("best", k, None if v is None else float(v)) for k, v in held_out.items()]
    return spark.createDataFrame(rows, METRIC_SCHEMA)
