"""Mixing sources to target weights by hierarchical budgeting.

Documents belong to leaves of a domain - language - source tree. The token
budget flows down from the root: a node's budget is shared among its children
by weight, no child gets more than its leaves can give (tokens times
``max_epochs``), and what a child cannot use goes to its siblings by weight;
only when all of them are full does the shortage reach the level above. A leaf
then takes whole epochs and, of one more epoch, the longest prefix of its
documents in that epoch's seeded order that fits the rest of the budget.

The prefix is found without sorting a leaf: tokens are summed per leaf and
1/4096 of the order's hash range, prefix sums find the one slice per leaf that
holds the border, and only that slice's documents are ordered. The corpus is
scanned, never shuffled.

Defined results: null domain, language or source count as ``(none)``; null
and empty texts have 0 tokens and come with their leaf's order; the order is a
hash of doc_id and text, so one seed draws the same documents from any layout
of the files, and its ties (repeated rows) are broken by row number; a
budget above what all leaves can give takes everything ``max_epochs`` times;
an empty table gives no rows; other columns pass through. One row per leaf
(of the metadata, not of the documents) passes the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohort_features.llm.common import drop, few_rows, join_small, numbered, store

LEVELS = ("domain", "lang", "source")
MAX_EPOCHS = 4
SLICES = 4096

# fixed weights of the registered mix; names not listed weigh 1
DOMAIN_WEIGHTS = {"d0": 4.0, "d1": 3.0, "d2": 2.0, "d3": 1.0}
LANG_WEIGHTS = {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0}


def weight(path: tuple[str, ...]) -> float:
    """Weight of a node among its siblings, by the path from the root."""
    table = {1: DOMAIN_WEIGHTS, 2: LANG_WEIGHTS}.get(len(path), {})
    return table.get(path[-1], 1.0)


def domain_of_source() -> Column:
    """The registered mix's domain: the source's number modulo 4."""
    number = F.regexp_extract("source", r"(\d+)$", 1)
    return F.when(number != "", F.concat(F.lit("d"), F.pmod(F.crc32(number), F.lit(4)).cast("string")))


def tokens() -> Column:
    """White-space separated words."""
    words = F.split(F.trim(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"\s", " ")), " +")
    return F.when(F.trim(F.coalesce(F.col("text"), F.lit(""))) == "", F.lit(0)).otherwise(F.size(words)).cast("long")


def shares(budget: int, weights: list[float], most: list[int]) -> list[int]:
    """Split ``budget`` by weight with a limit each; what a limit refuses goes
    to the others by weight. Whole numbers, sum min(budget, sum of limits)."""
    left, out, open_ = min(budget, sum(most)), [0] * len(most), [i for i, m in enumerate(most) if m]
    while open_ and left > 0:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] >= total * most[i]]
        if full:
            for i in full:
                out[i] = most[i]
            left -= sum(most[i] for i in full)
            open_ = [i for i in open_ if i not in set(full)]
            continue
        part = {i: math.floor(left * weights[i] / total) for i in open_}
        for i in sorted(open_, key=lambda i: (part[i] - left * weights[i] / total, i))[: left - sum(part.values())]:
            part[i] += 1
        for i, n in part.items():
            out[i] = min(n, most[i])
        break
    return out


def budgets(leaves: dict[tuple[str, ...], int], budget: int, max_epochs: int, weigh: Callable[[tuple[str, ...]], float] = weight) -> dict[tuple[str, ...], int]:
    """Token budget of each leaf, given each leaf's tokens."""
    out: dict[tuple[str, ...], int] = {}

    def down(paths: list[tuple[str, ...]], depth: int, amount: int) -> None:
        if len(paths) == 1 and len(paths[0]) == depth:
            out[paths[0]] = amount
            return
        children: dict[tuple[str, ...], list[tuple[str, ...]]] = {}
        for p in paths:
            children.setdefault(p[: depth + 1], []).append(p)
        names = sorted(children)
        limits = [sum(leaves[p] for p in children[c]) * max_epochs for c in names]
        weights = [max(0.0, weigh(c)) for c in names]
        limits = [m if w > 0 else 0 for m, w in zip(limits, weights, strict=True)]
        for c, amount_c in zip(names, shares(amount, weights, limits), strict=True):
            down(children[c], depth + 1, amount_c)

    if leaves:
        down(sorted(leaves), 0, budget)
    return out


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def mix(
    docs: DataFrame,
    budget: int | None = None,
    seed: int = 8,
    max_epochs: int = MAX_EPOCHS,
    weigh: Callable[[tuple[str, ...]], float] = weight,
    domain: Column | None = None,
    measure: Column | None = None,
) -> DataFrame:
    """The drawn documents: mix_rid, mix_leaf and mix_epoch (with underscores
    added where ``docs`` has such a column), then all columns; a document
    drawn in several epochs has as many rows.
    ``budget``: tokens; None: as many as the corpus holds."""
    spark = docs.sparkSession
    none = F.lit("(none)")
    path = F.array(F.coalesce((domain if domain is not None else domain_of_source()).cast("string"), none), *[F.coalesce(F.col(c).cast("string"), none) for c in LEVELS[1:]])
    count = measure if measure is not None else tokens()
    identity = F.xxhash64(*[F.col(c) for c in ("doc_id", "text") if c in docs.columns]).alias("mix_key")
    rows = numbered(docs, path.alias("mix_leaf"), identity, F.struct(*[F.col(c) for c in docs.columns]).alias("doc"))
    narrow = store(numbered(docs, path.alias("mix_leaf"), identity, count.alias("mix_tokens")), "tokens")

    sums = narrow.groupBy("mix_leaf").agg(F.sum("mix_tokens").alias("n"), F.count(F.lit(1)).alias("docs"))
    leaves = {tuple(r["mix_leaf"]): r["n"] for r in sums.collect()}
    given = budgets(leaves, sum(leaves.values()) if budget is None else budget, max_epochs, weigh)
    plan = []
    for leaf, n in leaves.items():
        whole, rest = divmod(given[leaf], n) if n else (1, 0)
        plan.append((list(leaf), int(whole), int(rest)))
    planned = few_rows(spark, plan, "mix_leaf array<string>, whole int, rest long")

    def order(epoch: Column) -> Column:
        return F.xxhash64(F.lit(seed), epoch, F.col("mix_key"))

    slice_of = F.pmod(F.shiftrightunsigned("u", 52), F.lit(SLICES)).cast("int")
    ordered = join_small(narrow, planned, "mix_leaf", rows=len(plan)).withColumn("u", order(F.col("whole"))).withColumn("slice", slice_of)
    per_slice = ordered.filter("rest > 0").groupBy("mix_leaf", "rest", "slice").agg(F.sum("mix_tokens").alias("n"))
    before = per_slice.withColumn("upto", F.sum("n").over(W.partitionBy("mix_leaf").orderBy("slice")))
    border = before.filter("upto > rest").groupBy("mix_leaf").agg(F.min(F.struct("slice", (F.col("upto") - F.col("n")).alias("base"))).alias("b"))
    border = store(border.select("mix_leaf", F.col("b.slice").alias("border"), F.col("b.base").alias("base")), "border")
    at_border = join_small(ordered.filter("rest > 0"), border, "mix_leaf", rows=len(plan)).filter("slice = border")
    run = F.sum("mix_tokens").over(W.partitionBy("mix_leaf").orderBy("u", "rid").rowsBetween(W.unboundedPreceding, 0))
    picked = store(at_border.withColumn("run", run).filter("base + run <= rest").select("rid", F.lit(1).alias("picked")), "picked")

    plan_all = store(planned.join(border, "mix_leaf", "left"), "plan")
    full = join_small(rows, plan_all, "mix_leaf", rows=len(plan)).withColumn("u", order(F.col("whole"))).withColumn("slice", slice_of)
    full = join_small(full, picked, "rid", "left")
    more = (F.col("rest") > 0) & (F.coalesce(F.col("slice") < F.col("border"), F.lit(False)) | F.col("picked").isNotNull())
    times = F.col("whole") + F.when(more, 1).otherwise(0)
    out = full.withColumn("mix_times", times).filter("mix_times > 0")
    out = out.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col("mix_times") - 1)))
    drop(narrow)
    own = [F.col(a).alias(_free(b, docs.columns)) for a, b in (("rid", "mix_rid"), ("mix_leaf", "mix_leaf"), ("mix_epoch", "mix_epoch"))]
    return out.select(*own, "doc.*")
