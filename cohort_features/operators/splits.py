"""Random splits with exact weights, the same on every layout (M2).

A row's draw is a hash of the seed, the row's content and its occurrence number
among equal rows, so it hangs on no partitioning. The threshold that leaves
exactly the wanted number of rows on a side is found digit by digit: four
histograms of 65,536 counts each, however many rows there are.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_features.session import materialize

DIGIT, DIGITS, CHUNK = 16, 4, 4096


def _digit(u: Column, level: int) -> Column:
    return F.shiftrightunsigned(u, DIGIT * (DIGITS - 1 - level)).bitwiseAND(F.lit((1 << DIGIT) - 1))


def threshold(rows: DataFrame, rank: int) -> int:
    """The ``rank``-th smallest (from 1) of the column ``_u``, as unsigned."""
    prefix: list[int] = []
    for level in range(DIGITS):
        same = rows
        for i, d in enumerate(prefix):
            same = same.filter(_digit(F.col("_u"), i) == d)
        counts = same.groupBy(_digit(F.col("_u"), level).alias("d")).count().collect()  # at most 65,536
        for r in sorted(counts, key=lambda r: r["d"]):
            if rank <= r["count"]:
                prefix.append(r["d"])
                break
            rank -= r["count"]
    out = 0
    for d in prefix:
        out = out << DIGIT | d
    return out


def split_exact(df: DataFrame, weights: list[float], seed: int = 42, out: str = "side") -> DataFrame:
    """``df`` with ``out``: 0 for the first weight's rows, 1 for the next's and
    so on. Sides hold the weights' shares of the rows, rounded half up, to the
    row. Equal rows are told apart by their count alone, so no group of them,
    however large, is numbered in one task. Columns must be groupable."""
    cols = df.columns
    rows = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {CHUNK}"))))
    last = F.least(F.col("_n") - 1, (F.col("_c") + 1) * CHUNK - 1)
    rows = rows.withColumn("_k", F.explode(F.sequence(F.col("_c") * CHUNK, last)))
    nulls = [F.col(c).isNull() for c in cols]  # xxhash64 passes over NULLs
    u = F.xxhash64(F.lit(seed), *[F.col(c) for c in cols], *nulls, F.col("_k"))
    rows = materialize(rows.select(*cols, u.alias("_u")), "drawn")
    n, total = rows.count(), sum(weights)
    ends = [int(n * w / total + 0.5) for w in accumulate(weights)][:-1]
    flip = -(1 << 63)  # signed longs in unsigned order
    side = F.lit(0)
    for k in ends:
        if k < 1:
            side = side + 1
        elif k < n:
            u = threshold(rows, k)
            side = side + (F.col("_u").bitwiseXOR(F.lit(flip)) > F.lit((u - (1 << 64) if u >= 1 << 63 else u) ^ flip)).cast("int")
    return rows.select(*cols, side.cast("int").alias(out))
