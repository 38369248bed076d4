"""Checkpoint folder handling and lineage cutting."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from cohort_features.plans import queries
from cohort_features.session import materialize, release, scratch_path, shared_dir
from tests.conftest import SF_SMALL


def test_shared_folder_is_the_sessions(spark):
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir().rstrip("/")
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1 != p2 and p1.startswith(shared_dir(spark))


def _listing(spark):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {str(s.getPath().getName()) for s in fs.listStatus(path)} if fs.exists(path) else set()


def test_release_removes_what_queries_wrote(spark):
    release(spark)
    before = _listing(spark)
    for name in ("csv_scan", "csv_ingest", "features_roundtrip"):
        assert queries.QUERIES[name](spark, SF_SMALL).count() > 0
    assert _listing(spark) > before
    release(spark)
    assert _listing(spark) == before


def test_planning_the_flagship_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "planning")
    try:
        df = queries.stay_features(spark, SF_SMALL)
        with contextlib.redirect_stdout(io.StringIO()):
            df.explain("formatted")
        jobs = tracker.getJobIdsForGroup("plan-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # reading a table's schema runs a one-task job on the footer; nothing else may run
    stages = [s for j in jobs for s in tracker.getJobInfo(j).stageIds]
    assert all(tracker.getStageInfo(s) is None or tracker.getStageInfo(s).numTasks == 1 for s in stages)


def test_materialize_cuts_lineage(spark):
    a = spark.range(1000).withColumn("k", F.col("id") % 7)
    b = spark.range(7).withColumnRenamed("id", "k")
    joined = a.join(b, "k").groupBy("k").count()
    cut = materialize(joined, "cut-test")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        cut.explain()
    plan = buf.getvalue()
    # the re-read table is a plain Parquet scan: no join or aggregate upstream
    assert "FileScan parquet" in plan and "Join" not in plan and "HashAggregate" not in plan
    assert sorted(tuple(r) for r in cut.collect()) == sorted(tuple(r) for r in joined.collect())
