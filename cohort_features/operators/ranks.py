"""Running totals and dense ranks of whole tables, and one-hot vectors.

A window without a partition key would put a table into one task. Here rows
are dealt by ranges of the order, each range is summed by itself, and the
ranges' totals (one small row each) are summed before it.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohort_features.session import materialize


def running_totals(df: DataFrame, order: list[str], sums: dict[str, Column], group: list[str] | None = None) -> DataFrame:
    """``df`` with the sums over the rows up to each in ``order`` (which must
    be unique per row within ``group``), per value of ``group``."""
    group = group or []
    keys = [*group, *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = materialize(dealt.select("*", F.spark_partition_id().alias("_range"), *[c.alias(f"_{n}") for n, c in sums.items()]), "ranges")
    before = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    totals = dealt.groupBy("_range", *group).agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in sums])  # ranges x groups
    totals = totals.select("_range", *group, *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in sums])
    within = W.partitionBy("_range", *group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    rows = dealt.select(*df.columns, "_range", *[F.sum(f"_{n}").over(within).alias(f"_upto_{n}") for n in sums])
    same = [rows["_range"] == totals["_range"], *[rows[g].eqNullSafe(totals[g]) for g in group]]
    return rows.join(totals, same).select(*[rows[c] for c in df.columns], *[(F.col(f"_upto_{n}") + F.col(f"_before_{n}")).alias(n) for n in sums])


def vocabulary(df: DataFrame, col: str) -> DataFrame:
    """(category, index): the distinct non-NULL values of ``col``, numbered
    from 0 in ascending order. Nothing is collected."""
    values = df.select(F.col(col).alias("category")).filter(F.col("category").isNotNull()).distinct()
    return running_totals(values, ["category"], {"_n": F.lit(1).cast("long")}).select("category", (F.col("_n") - 1).alias("index"))


def one_hot_vectors(df: DataFrame, key: list[str], col: str) -> DataFrame:
    """``key``, category, index, size and ``vector``: a sparse 0/1 ML vector
    over the column's own values. Rows with NULL have no category and are left
    out; the vocabulary is joined by Spark's own choice of join."""
    words = materialize(vocabulary(df, col), "vocabulary")
    size = words.count()
    rows = df.select(*key, F.col(col).alias("category")).join(words, "category").withColumn("size", F.lit(size).cast("long"))
    if not size:
        return rows.withColumn("vector", F.lit(None))
    # the size is the vocabulary's, whichever rows there are
    encoder = OneHotEncoder(inputCols=["index"], outputCols=["vector"], dropLast=False).fit(words)
    return encoder.transform(rows).select(*key, "category", "index", "size", "vector")
