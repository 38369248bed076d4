"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of 1024 characters. Equal blocks get one integer
name: the distinct blocks are grouped by content, sorted within their
partition, and numbered. Then adjacent names are paired and the distinct pairs
named the same way, level by level, until one name is left per document
(Karp, Miller and Rosenberg's naming). Names stand for contents compared in
full, never for hashes, so equal identities mean equal texts and unequal
identities unequal texts. A text of n blocks takes ceil(log2 n) levels.

Hot contents (a block or pair that over 1/1000 of the rows hold) are found by
a count on a narrow hash, named apart and joined by broadcast (there are at
most 1000 of them); all others meet their names in a shuffle join.

Defined results: null text counts as empty; repeated rows are documents of
their own; of equal texts the row with the largest doc_id stays (null doc_ids
below all others; among rows with equal doc_id the last read); other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_features.llm.common import HOT_ROWS, drop, numbered, store, text_or_empty, with_group

BLOCK = 1024
NONE = -(2**63)  # stands for the missing second half of a last pair; never a name


def blocks(text: Column, size: int = BLOCK) -> Column:
    """The text's blocks in order; one empty block for the empty text."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(cut)


def named(rows: DataFrame, key: list[str], total: int) -> DataFrame:
    """``rows`` with ``name``: one integer per distinct value of ``key``.

    Names are positive for ordinary contents, negative for hot ones. ``key``
    must not be null. The result must be stored before it is used twice."""
    def distinct(some: DataFrame) -> DataFrame:
        values = some.groupBy(*key).agg(F.lit(1).alias("_one")).drop("_one").sortWithinPartitions(*key)
        return values.withColumn("name", F.monotonically_increasing_id())

    limit = max(HOT_ROWS, total // 1000)
    if total <= limit:
        return rows.join(distinct(rows), key)
    digest = F.xxhash64(*key)
    spark = rows.sparkSession
    hot = rows.groupBy(digest.alias("_h")).count().filter(F.col("count") > limit).select("_h").collect()  # at most 1000
    if not hot:
        return rows.join(distinct(rows), key)
    hashes = F.broadcast(spark.createDataFrame(hot, "_h long"))
    marked = rows.withColumn("_h", digest)
    often = marked.join(hashes, "_h", "left_semi").drop("_h")
    values = often.groupBy(*key).agg(F.lit(1).alias("_one")).drop("_one").orderBy(*key).collect()  # contents of those hashes
    schema = often.select(*key, F.lit(1).cast("long").alias("name")).schema
    names = spark.createDataFrame([(*v, -1 - i) for i, v in enumerate(values)], schema)
    seldom = marked.join(hashes, "_h", "left_anti").drop("_h")
    return often.join(F.broadcast(names), key).unionByName(seldom.join(distinct(seldom), key))


def identities(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """Stored (rid, level, name): two texts are equal exactly if both level
    and name are. ``docs`` has rid and text and is read from stored files."""
    cut = docs.select("rid", blocks(text_or_empty(), size).alias("all"))
    cut = cut.select("rid", F.size("all").cast("long").alias("n"), F.posexplode("all").alias("i", "block"))
    total = docs.select(F.sum(F.greatest(F.lit(1), F.ceil(F.length(text_or_empty()) / size)))).first()[0] or 0
    level = store(named(cut, ["block"], total).select("rid", F.col("i").cast("long"), "n", "name"), "level0")
    done, depth = [level.filter("n = 1").select("rid", F.lit(0).alias("level"), "name")], 0
    rest, used = level.filter("n > 1"), [level]
    while True:
        total = rest.count()
        if not total:
            break
        depth += 1
        pairs = rest.groupBy("rid", F.expr("i div 2").alias("i")).agg(
            F.max(F.expr("IF(i % 2 = 0, name, null)")).alias("a"),
            F.coalesce(F.max(F.expr("IF(i % 2 = 1, name, null)")), F.lit(NONE)).alias("b"),
            F.max(F.expr("(n + 1) div 2")).alias("n"),
        )
        pairs = store(pairs, "pairs")
        level = store(named(pairs, ["a", "b"], pairs.count()).select("rid", "i", "n", "name"), f"level{depth}")
        drop(pairs)
        done.append(level.filter("n = 1").select("rid", F.lit(depth).alias("level"), "name"))
        rest = level.filter("n > 1")
        used.append(level)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    out = store(out, "identities")
    drop(*used)
    return out


def exact_duplicates(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row per document: rid, doc_id, keep_id, group_size, kept,
    text_sha256."""
    rows = numbered(docs, "doc_id", "text")
    ids = identities(rows, size)
    about = rows.select("rid", "doc_id", F.sha2(F.encode(text_or_empty(), "UTF-8"), 256).alias("text_sha256"))
    each = store(ids.join(about, "rid").withColumn("identity", F.struct("level", "name")), "each")
    drop(ids)
    best = F.max(F.struct("doc_id", "rid")).alias("best")
    out = with_group(each, "identity", [best, F.count(F.lit(1)).alias("group_size")])
    return out.select(
        "rid", "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("best.rid") == F.col("rid")).alias("kept"), "text_sha256"
    )
