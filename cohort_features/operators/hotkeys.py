"""Keys that hold more rows than one task should take, found by a sketch.

``hot_keys`` counts a table's keys in one scan with Spark's own mergeable
frequent-items sketch (Misra-Gries counters): every map task sends one sketch
of bounded size, never a row per key. A key that holds over ``1 / COUNTERS``
of the rows cannot be missed; its count may be too high by that share of the
rows, never too low. At most ``MOST`` keys reach the driver.

``spread_join`` joins many rows per key with a table that has one. Only hot
keys are salted, each by its own count, so the rows of a key that holds a third
of a table go to as many tasks as they need and the other side is repeated for
hot keys alone. Without hot keys it is a plain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

COUNTERS = 1 << 16
MOST = 10_000
ROWS_PER_TASK = 1_000_000


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK, scale: float = 1.0) -> dict:
    """{key: rows} of the keys with over ``rows_per_task`` rows, where each row
    of ``df`` stands for ``scale`` rows. NULL keys join nothing and are left
    out. One job over one column; an empty table has no hot keys."""
    found = df.where(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {MOST}, {COUNTERS})").alias("top"))
    often = found.select(F.explode("top").alias("t")).select(F.col("t.item").alias("k"), F.col("t.count").alias("n"))
    return {r["k"]: int(r["n"] * scale) for r in often.where(F.col("n") * F.lit(scale) > rows_per_task).collect()}


def spread_join(
    rows: DataFrame, unique: DataFrame, key: str, hot: dict, rows_per_task: int = ROWS_PER_TASK, how: str = "inner"
) -> DataFrame:
    """Join of many rows per ``key`` with a table that has one (``how``: inner
    or left). ``hot`` maps hot keys to their row counts; the counts only set
    how widely a key is spread, so a wrong one changes no result. Rows are
    dealt by a hash of all their columns."""
    if not hot:
        return rows.join(unique, on=key, how=how)
    field = StructField(key, rows.schema[key].dataType)
    counts = [(k, max(1, -(-n // rows_per_task))) for k, n in sorted(hot.items())]
    # at most MOST rows of two columns
    salts = F.broadcast(rows.sparkSession.createDataFrame(counts, StructType([field, StructField("_salts", IntegerType())])))
    dealt = F.pmod(F.xxhash64(*rows.columns), F.coalesce("_salts", F.lit(1))).cast("int")
    left = rows.join(salts, on=key, how="left").withColumn("_salt", dealt).drop("_salts")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    right = unique.join(salts, on=key, how="left").withColumn("_salt", each).drop("_salts")
    return left.join(right, on=[key, "_salt"], how=how).drop("_salt")
