"""One subject holds a third of all rows: results stay exact, the hot key's
raw rows never meet in one task, and AQE splits the hot join partition."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from cohort_features.functions.catalog import Component, Measure, MeasureCatalogue
from cohort_features.operators import cohort, hotkeys, measures

CAT = MeasureCatalogue(
    components=(
        Component("hr", "charts", (1,), "valuenum", scale=2),
        Component("bp", "charts", (2, 3), "valuenum", scale=2),
    ),
    measures=(Measure("avg_hr", "mean", ("hr",)), Measure("avg_bp", "mean", ("bp",))),
)


def _skewed_events(spark, n=30000):
    # subject 0 owns every third row; the rest spread over 1000 subjects
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).cast("long").alias("subject_id"),
        (F.col("id") % 3 + 1).cast("int").alias("itemid"),
        ((F.col("id") * 7919 % 10000) / 100.0).alias("valuenum"),
    )


def test_hot_subject_measures_exact(spark):
    ev = _skewed_events(spark).repartition(6)
    got = {r["subject_id"]: (r["avg_hr"], r["avg_bp"]) for r in
           measures.subject_measures({"charts": ev}, CAT).collect()}
    rows = ev.collect()
    want: dict[int, list[list[float]]] = {}
    for r in rows:
        slot = want.setdefault(r["subject_id"], [[], []])
        slot[0 if r["itemid"] == 1 else 1].append(r["valuenum"])
    from decimal import ROUND_HALF_UP, Decimal

    def mean2(vs):
        if not vs:
            return None
        cents = sum(round(v * 100) for v in vs)
        return float((Decimal(cents) / Decimal(len(vs))).quantize(Decimal(1), ROUND_HALF_UP) / 100)

    assert got == {s: (mean2(a), mean2(b)) for s, (a, b) in want.items()}


def test_measure_aggregate_is_partial_before_shuffle(spark):
    ev = _skewed_events(spark)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        measures.subject_measures({"charts": ev}, CAT).explain()
    plan = buf.getvalue()
    # map-side partial aggregation below the exchange, final above it
    assert "partial_sum" in plan and "Exchange hashpartitioning(subject_id" in plan


def test_hot_subject_stay_join_is_split(spark):
    n = 60000
    adm = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000 + 1).cast("long").alias("subject_id"),
        F.col("id").alias("hadm_id"),
        F.lit("2150-01-01 00:00:00").cast("timestamp").alias("admittime"),
        (F.col("id") % 2).cast("int").alias("hospital_expire_flag"),
    )
    stays = spark.range(n).select(F.col("id").alias("hadm_id"), (F.col("id") % 9 / 2.0).alias("los"))
    pats = spark.range(5001).select(
        F.col("id").alias("subject_id"),
        F.lit("2100-06-01 00:00:00").cast("timestamp").alias("dob"),
        F.when(F.col("id") % 2 == 0, "M").otherwise("F").alias("gender"),
    )
    dx = spark.range(5001).select(F.col("id").alias("subject_id"), F.lit("4280").alias("icd9_code"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in [*conf, "spark.sql.adaptive.skewJoin.enabled"]}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        # two salts for the 20,000 stays of the hot subject: AQE splits each further
        out = cohort.stay_cohort(adm, stays, pats, dx, rows_per_task=15000)
        sel = out.select("subject_id", "hadm_id", "los", "age")
        rows = sel.collect()
        assert len(rows) == n
        assert sum(1 for r in rows if r["subject_id"] == 0) == n // 3
        assert {r["age"] for r in rows} == {49}
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            sel.explain()  # the executed (final) adaptive plan of ``sel``
        plan = buf.getvalue()
        assert "isFinalPlan=true" in plan
        assert "skew=true" in plan
        # the salt alone deals the hot subject to several tasks
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        sel = cohort.stay_cohort(adm, stays, pats, dx, rows_per_task=4000).select("subject_id", "hadm_id", "los", "age")
        parts = sel.withColumn("p", F.spark_partition_id()).filter("subject_id = 0").select("p").distinct().count()
        assert parts >= 3
        assert sorted(sel.collect()) == sorted(rows)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_keys_are_found_and_salted_by_their_counts(spark):
    ids = spark.range(40000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") + 100).alias("k"),
        F.col("id").alias("v"),
    )
    hot = hotkeys.hot_keys(ids, "k", 1000)
    assert hot == {7: 13334}
    assert hotkeys.hot_keys(ids.limit(0), "k", 1000) == {}
    unique = ids.select("k").dropna().distinct().withColumn("w", F.col("k") * 2)
    plain = sorted(map(tuple, ids.join(unique, "k").select("k", "v", "w").collect()))
    for counts in (hot, {7: 1}, {7: 10**6, 100: 5000, -1: 9999}):  # counts set the spread, never the rows
        got = hotkeys.spread_join(ids, unique, "k", counts, 1000)
        assert sorted(map(tuple, got.select("k", "v", "w").collect())) == plain
    left = hotkeys.spread_join(ids, unique, "k", hot, 1000, how="left")
    assert left.count() == 40000 and left.filter("w is null").count() == ids.filter("k is null").count()
    # the other side is repeated for the hot key alone
    right = hotkeys.spread_join(unique.select("k"), unique, "k", hot, 1000)
    assert right.count() == unique.count()


def test_one_admission_with_a_third_of_all_stays(spark):
    n = 9000
    adm = spark.range(3000).select(
        (F.col("id") % 1000).alias("subject_id"),
        F.col("id").alias("hadm_id"),
        F.lit("2150-01-01 00:00:00").cast("timestamp").alias("admittime"),
        F.lit(0).alias("hospital_expire_flag"),
    )
    stays = spark.range(n).select(F.when(F.col("id") % 3 == 0, 1500).otherwise(F.col("id") % 3000).alias("hadm_id"), F.col("id").cast("double").alias("los"))
    hot = cohort.hot_subjects(adm, stays, 1000)
    assert list(hot) == [500] and hot[500] >= n // 3
    pats = spark.range(1000).select(F.col("id").alias("subject_id"), F.lit("2100-06-01").cast("timestamp").alias("dob"), F.lit("M").alias("gender"))
    dx = spark.range(1000).select(F.col("id").alias("subject_id"), F.lit("4280").alias("icd9_code"))
    cols = ["subject_id", "hadm_id", "los", "age"]
    salted = cohort.stay_cohort(adm, stays, pats, dx, rows_per_task=1000).select(*cols).collect()
    assert sorted(salted) == sorted(cohort.stay_cohort(adm, stays, pats, dx).select(*cols).collect())
    assert len(salted) == n
