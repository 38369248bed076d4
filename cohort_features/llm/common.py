"""Helpers shared by the operators: stored tables, row ids, group lookups.

* ``store`` cuts lineage with a Parquet table under the shared folder that the
  session names in ``spark.checkpoint.dir``; a lost executor re-reads files.
* ``with_group`` joins per-key aggregates back to the rows without ever
  sending a hot key's rows to one task.
* ``join_small`` broadcasts a side only after counting it, and shuffles it
  beyond the bound.
* ``bounded_sample`` brings a bounded sample to the driver.
"""

from __future__ import annotations

import gc
import os
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from cohort_features.session import remove, shared_dir

#: rows of (two or three longs) that may be broadcast; more are shuffled
BROADCAST_ROWS = 400_000
#: a key is hot when it holds more rows than this and over 1/1000 of them all
HOT_ROWS = 20_000

ONE_THREAD = {"RAYON_NUM_THREADS": "1", "TOKENIZERS_PARALLELISM": "false", "OMP_NUM_THREADS": "1"}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else the warehouse: both
    are the session's own and every executor sees them."""
    return shared_dir(spark)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete stored tables that no later plan reads."""
    for t in tables:
        path = getattr(t, "_stored_at", None)
        if path:
            remove(t.sparkSession, path)


def free_shuffles(df: DataFrame) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any
    more: it does so when the driver's JVM collects its garbage, which a driver
    with little to do may not do for half an hour."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


FILE_BITS = 40  # bits of a row number that number the row in its file
MOST_FILES = 400_000  # files whose numbers may be broadcast


def _plain_read(docs: DataFrame) -> bool:
    """Whether ``docs`` is a Parquet read with nothing but columns and filters
    above it, so that each row is one row of one file."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    if plan.nodeName() != "LogicalRelation" or "HadoopFsRelation" not in plan.relation().getClass().getName():
        return False
    return "Parquet" in plan.relation().fileFormat().getClass().getName()


def numbered(docs: DataFrame, *keep: str | Column) -> DataFrame:
    """``keep`` of ``docs`` with a row number ``rid`` (unique, not dense), so
    that repeated or null doc_ids stay apart. The number is the place of the
    row's file among the files by path, and the row's place in that file: the
    same in every plan, whatever splits, cores or executors there are. Splits
    don't enter it. What is no plain read of Parquet files (or one of too many
    files to number) is written once, and the copy is numbered."""
    here = getattr(docs, "_copy", docs)
    if here is docs and not _plain_read(docs):
        here = docs._copy = store(docs, "copy")
    place = here.metadataColumn("_metadata")
    files = here.select(place["file_path"].alias("_file")).distinct()
    names = sorted(r["_file"] for r in files.limit(MOST_FILES + 1).collect())  # paths, as many as there are files
    if len(names) > MOST_FILES and here is docs:
        docs._copy = store(docs.coalesce(MOST_FILES // 4), "copy")
        return numbered(docs, *keep)
    if len(names) < 2:
        return here.select(place["row_index"].alias("rid"), *keep)
    ranks = docs.sparkSession.createDataFrame(pa.table({"_rank": range(len(names)), "_file": names}))
    placed = here.select(place["file_path"].alias("_file"), place["row_index"].alias("_row"), *keep).join(F.broadcast(ranks), "_file")
    rid = F.shiftleft("_rank", FILE_BITS).bitwiseOR(F.col("_row")).alias("rid")
    return placed.select(rid, *[F.col(c) for c in placed.columns if c not in ("_file", "_row", "_rank")])


def whole_rows(docs: DataFrame) -> DataFrame:
    """``rid`` and all columns of ``docs`` as one struct ``doc``."""
    return numbered(docs, F.struct(*[F.col(c) for c in docs.columns]).alias("doc"))


def text_or_empty() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def join_small(df: DataFrame, side: DataFrame, key, how: str = "inner", rows: int | None = None) -> DataFrame:
    """Join with a narrow ``side``: broadcast if it was counted to hold at
    most ``BROADCAST_ROWS`` rows, shuffled otherwise. Same result either way."""
    n = side.count() if rows is None else rows
    return df.join(F.broadcast(side) if n <= BROADCAST_ROWS else side, key, how)


def few_rows(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """A table of a few rows from the driver, sent as Arrow: Spark turns lists
    into rows in Python, in workers that every executor starts for it beside
    those of the operators, and keeps."""
    schema = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)
    columns = zip(*rows, strict=True) if rows else [[] for _ in arrow]
    return spark.createDataFrame(pa.table([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow), schema)


def with_group(df: DataFrame, key: str, aggs: list[Column], rows: int | None = None) -> DataFrame:
    """``df`` with the aggregates of its key. Aggregation is partial + final;
    keys that hold over 1/1000 of the rows (so at most 1000 keys) come back by
    broadcast, all others by a shuffle join. ``key`` must not be null and
    ``df`` should be a stored table, as it is read more than once."""
    total = df.count() if rows is None else rows
    limit = max(HOT_ROWS, total // 1000)
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    if total <= limit:
        return df.join(groups.drop("_rows"), key)
    hot = groups.filter(F.col("_rows") > limit).drop("_rows").toArrow()  # at most 1000 rows
    if not hot.num_rows:
        return df.join(groups.drop("_rows"), key)
    few = F.broadcast(df.sparkSession.createDataFrame(hot, groups.drop("_rows").schema))
    is_hot = df.join(few, key)
    rest = df.join(few.select(key), key, "left_anti")
    cold = rest.join(groups.filter(F.col("_rows") <= limit).drop("_rows"), key)
    return is_hot.unionByName(cold.select(*is_hot.columns))


def bounded_sample(df: DataFrame, most: int, *keys: str) -> list:
    """At most ``most`` rows on the driver, chosen by the hash of ``keys``. A
    hash threshold thins the rows first, so that partitions send the driver
    little more than that in all, however many there are."""
    n, h = df.count(), F.xxhash64(*keys)
    if n > most:
        span = 1 << 30
        df = df.filter(F.pmod(h, F.lit(span)) < F.lit(int(span * min(1.0, 1.25 * most / n))))
    return df.orderBy(h, *keys).limit(most).collect()


def python_env() -> None:
    """One thread for each Python worker; called before native libraries load."""
    for k, v in ONE_THREAD.items():
        os.environ.setdefault(k, v)
