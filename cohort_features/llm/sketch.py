"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the k smallest distinct 64-bit hashes of a text's 5-word shingles.
Sketches merge (the k smallest of the union), and give the number of distinct
shingles (k - 1) / (k-th smallest, scaled to 0..1), resemblance (the share of
common hashes among the k smallest of the union) and containment. Below k
distinct shingles all three are exact.

``edited`` builds, for every document, the text whose last quarter is replaced
by the start of the next document in ascending doc_id. The texts are dealt
once by ranges of the order (doc_id, hash of the text). The exact first key of
each range is found beforehand on narrow rows, and a copy of that first
document also goes to the end of the range before it (of the first document
to the last range), so every task has the successor of its last document and
nothing else crosses a border.

Defined results: null text counts as empty and has the empty fingerprint;
likeness of two empty fingerprints is 1, of an empty and another 0; rows
without doc_id come first; rows with equal doc_id are ordered by text hash and
follow each other; a lone document is its own next; other columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_features.llm.batches import map_rows
from cohort_features.llm.common import text_or_empty
from cohort_features.llm.words import shingle_set

K = 128
SHINGLE = 5


def sketch(text: str | None, k: int = K, shingle: int = SHINGLE) -> np.ndarray:
    """The k smallest distinct shingle hashes, ascending."""
    return shingle_set(text, shingle)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of both texts' shingles."""
    return np.union1d(a, b)[:k]


def distinct_count(s: np.ndarray, k: int = K) -> float:
    return float(len(s)) if len(s) < k else (k - 1) / ((float(s[k - 1]) + 1) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge(a, b, k)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).sum() / len(union))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Share of a's distinct shingles that b also has."""
    if not len(a):
        return 1.0
    union = distinct_count(merge(a, b, k), k)
    return float(min(1.0, resemblance(a, b, k) * union / distinct_count(a, k)))


def to_text(s: np.ndarray) -> str:
    return base64.b64encode(s.astype("<u8").tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), "<u8")


def fingerprints(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text) to (doc_id, fingerprint, n_distinct)."""

    def run(rows):
        for doc_id, text in rows:
            s = sketch(text, k, shingle)
            yield doc_id, to_text(s), distinct_count(s, k)

    return map_rows(docs.select("doc_id", "text"), run, "doc_id long, fingerprint string, n_distinct double")


def _first_keys(keyed: DataFrame, n: int) -> list[tuple]:
    """Exact smallest (null flag, doc_id, hash) of each range, ascending: one
    row per range, found on narrow rows."""
    ranged = keyed.repartitionByRange(n, "has", "id", "h").select(F.spark_partition_id().alias("p"), F.struct("has", "id", "h").alias("key"))
    return sorted(tuple(r["key"]) for r in ranged.groupBy("p").agg(F.min("key").alias("key")).collect())


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (part, last, has, id, h, doc_id, text) dealt by part and sorted:
    each part's documents in order, then (last > 0) a copy of the document
    that follows the part's last one."""
    keyed = docs.select(
        F.col("doc_id").isNotNull().cast("int").alias("has"),
        F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"),
        F.xxhash64(text_or_empty()).alias("h"),
        "doc_id",
        text_or_empty().alias("text"),
    )
    spark = docs.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    firsts = _first_keys(keyed.select("has", "id", "h"), n)

    @F.pandas_udf("array<struct<part: int, last: int>>")
    def places(has: pd.Series, i: pd.Series, h: pd.Series) -> pd.Series:
        out = []
        for key in zip(has.tolist(), i.tolist(), h.tolist(), strict=True):
            part = bisect.bisect_right(firsts, key) - 1
            at = [(part, 0)]
            if firsts[part] == key:  # the part's first document also ends the part before
                at.append(((part - 1) % len(firsts), 1))
            out.append([{"part": p, "last": x} for p, x in at])
        return pd.Series(out)

    dealt = keyed.withColumn("at", F.explode(places("has", "id", "h"))).select("at.part", "at.last", "has", "id", "h", "doc_id", "text")
    return dealt.repartition(n, "part").sortWithinPartitions("part", "last", "has", "id", "h")


def edited_fingerprints(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, n_distinct."""

    def finish(doc_id, text, own, nxt, other):
        n = len(text)
        cut = n // 4
        new = text[: n - cut] + nxt[:cut]
        mine = sketch(new, k, shingle)
        return (
            doc_id, n, hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), to_text(own), to_text(mine),
            resemblance(own, mine, k), resemblance(own, other, k), distinct_count(own, k),
        )

    def run(rows):
        at, held = None, None
        for part, last, doc_id, text in rows:
            if last and part != at:
                continue  # a second copy of that document (repeated rows)
            s = sketch(text, k, shingle)
            if part == at and held:
                yield finish(*held, text, s)
            at, held = (None, None) if last else (part, (doc_id, text, s))

    dealt = with_next(docs)
    return map_rows(
        dealt.select("part", "last", "doc_id", "text"),
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_distinct double",
    )
