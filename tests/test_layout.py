"""Tables in buckets of the subject: no shuffle later, hot subjects beside
them, the same rows as from plain tables."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from cohort_features.functions.catalog import Component, Measure, MeasureCatalogue
from cohort_features.operators.measures import subject_measures
from cohort_features.sources.layout import open_layout, write_by_subject

CAT = MeasureCatalogue(
    components=(
        Component("hr", "charts", (1, 2), "valuenum", scale=2),
        Component("na", "labs", (3,), "valuenum", scale=2),
        Component("urine", "outputs", (1, 3), "valuenum", scale=2),
    ),
    measures=(Measure("avg_hr", "mean", ("hr",)), Measure("avg_na", "mean", ("na",)), Measure("avg_urine", "mean", ("urine",))),
)


@pytest.fixture()
def large_plans(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _tables(spark):
    """Subject 0 owns a third of the charts; some rows have no subject."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 90 + 1).cast("long").alias("subject_id"),
        (F.col("id") % 4).cast("int").alias("itemid"),
        ((F.col("id") * 7919 % 10000) / 100.0).alias("valuenum"),
    )
    return {"charts": rows, "labs": rows.filter("subject_id is null or subject_id % 7 < 5"), "outputs": rows.filter("valuenum < 70")}


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("\n\n")[0]


@pytest.mark.parametrize("complete", [False, True])
def test_no_exchange_and_the_same_rows(large_plans, scratch, complete):
    tables = _tables(large_plans)
    want = sorted(map(str, subject_measures(tables, CAT, complete=complete).collect()))
    stored = write_by_subject(tables, scratch + "/by", buckets=4, rows_per_task=10**6)
    out = stored.per_subject(lambda t: subject_measures(t, CAT, complete=complete))
    # a full outer join's key has no known partitioning: the third table then meets it by a shuffle of aggregated rows
    assert stored.hot is None and _plan(out).count("Exchange") == (0 if complete else 1)
    assert sorted(map(str, out.collect())) == want


def test_hot_subjects_lie_beside_the_buckets(large_plans, scratch):
    tables = _tables(large_plans)
    want = sorted(map(str, subject_measures(tables, CAT).collect()))
    stored = write_by_subject(tables, scratch + "/by", buckets=4, rows_per_task=500)
    assert stored.hot_subjects == (0,)
    assert stored.many["charts"].filter("subject_id = 0").isEmpty()
    assert stored.many["charts"].count() + stored.hot["charts"].count() == 6000
    assert sorted(map(str, stored.per_subject(lambda t: subject_measures(t, CAT)).collect())) == want
    again = open_layout(large_plans, scratch + "/by", {n: t.schema for n, t in tables.items()}, "subject_id", 4, stored.hot_subjects)
    assert sorted(map(str, again.per_subject(lambda t: subject_measures(t, CAT)).collect())) == want


def test_empty_tables(large_plans, scratch):
    tables = {n: t.limit(0) for n, t in _tables(large_plans).items()}
    stored = write_by_subject(tables, scratch + "/by", buckets=4)
    assert stored.per_subject(lambda t: subject_measures(t, CAT)).count() == 0
