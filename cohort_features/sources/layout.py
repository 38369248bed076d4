"""Event tables laid out by subject, so that per-subject work needs no shuffle.

``write_by_subject`` stores tables as buckets of the subject key, all with one
bucket count: an aggregate per subject, and inner joins of such aggregates, then read
their buckets side by side without an exchange (a full outer join of more than
two shuffles aggregated rows). The one shuffle is paid when the data comes in.

A bucket is one task's work, so subjects that hold more rows than a task should
take (found by ``hotkeys.hot_keys`` in any of the tables) lie in plain files
beside the buckets. ``Layout.per_subject`` builds the same result from both: the
many subjects without a shuffle, the hot ones by partial aggregates, as ever.
The two sets of subjects are disjoint, so their results are united as they are.

Rows without a subject are kept, in the buckets. A layout is described by its
folder, key, bucket count and hot subjects; ``open_layout`` reads it in another
session.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_features.operators.hotkeys import ROWS_PER_TASK, hot_keys


@dataclass(frozen=True)
class Layout:
    """Tables by subject: ``many`` in buckets, ``hot`` (or None) in plain files."""

    many: dict[str, DataFrame]
    hot: dict[str, DataFrame] | None
    hot_subjects: tuple

    def per_subject(self, build: Callable[[dict[str, DataFrame]], DataFrame]) -> DataFrame:
        """``build`` over the tables; its rows must come from one subject each."""
        many = build(self.many)
        return many if self.hot is None else many.unionByName(build(self.hot))


def _bucketed(spark: SparkSession, name: str, path: str, df_schema, key: str, buckets: int) -> DataFrame:
    """The stored buckets as a table of the session's catalog."""
    table = f"{name}_{uuid.uuid4().hex}"
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df_schema.fields)
    spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def open_layout(spark: SparkSession, folder: str, schemas: dict, key: str, buckets: int, hot_subjects: tuple = ()) -> Layout:
    """A layout that ``write_by_subject`` stored in ``folder``."""
    many = {n: _bucketed(spark, n, f"{folder}/{n}", s, key, buckets) for n, s in schemas.items()}
    hot = {n: spark.read.schema(s).parquet(f"{folder}/{n}-hot") for n, s in schemas.items()} if hot_subjects else None
    return Layout(many, hot, tuple(hot_subjects))


def write_by_subject(
    tables: dict[str, DataFrame], folder: str, key: str = "subject_id", buckets: int = 200, rows_per_task: int = ROWS_PER_TASK
) -> Layout:
    """Store ``tables`` by ``key`` below ``folder``. ``buckets``: rows / rows
    per task of the largest table, the same for tables that meet. Every table
    is shuffled once to its buckets, so a bucket is one file."""
    spark = next(iter(tables.values())).sparkSession
    often: set = set()
    for df in tables.values():
        often |= set(hot_keys(df, key, rows_per_task))
    hot = tuple(sorted(often))
    for name, df in tables.items():
        is_hot = F.coalesce(F.col(key).isin(list(hot)), F.lit(False)) if hot else F.lit(False)
        rows = df.filter(~is_hot) if hot else df
        table = f"{name}_{uuid.uuid4().hex}"
        writer = rows.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
        writer.option("path", f"{folder}/{name}").saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")  # the files stay: the table is external
        if hot:
            df.filter(is_hot).write.parquet(f"{folder}/{name}-hot")
    return open_layout(spark, folder, {n: df.schema for n, df in tables.items()}, key, buckets, hot)
