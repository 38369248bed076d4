"""The operators over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_features.llm import bpe, exact, language, lines, minhash, mixing, negatives, packing, pii, quality, repair, sketch, substring
from cohort_features.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 20 words or more that repeat across documents."""
    out = substring.repeated_passages(documents(spark, sf_dir))
    return out.select("doc_id", "start_word", "n_words", "removed_words", "keep_doc_ids")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of 2048-token sequences."""
    return packing.pack(documents(spark, sf_dir)).drop("ids")


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that has copies or near copies, and the line that stays."""
    return lines.duplicate_lines(documents(spark, sf_dir), complete=True).drop("rid")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups: 3-word shingles, similarity 0.85 or more."""
    out = minhash.near_duplicates(documents(spark, sf_dir), shingle=3, percent=85)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op5_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, with likenesses."""
    return sketch.edited_fingerprints(documents(spark, sf_dir))


def op6_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates; the largest doc_id stays."""
    return exact.exact_duplicates(documents(spark, sf_dir)).drop("rid")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality scores; a fifth of the labels is held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.score_quality(documents(spark, sf_dir), labels).drop("rid")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights, as many tokens as there are."""
    out = mixing.mix(documents(spark, sf_dir))
    leaf = [F.col("mix_leaf")[i].alias(name) for i, name in enumerate(mixing.LEVELS)]
    return out.select("doc_id", *leaf, F.col("mix_epoch").cast("long").alias("epoch"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every text, and its mixture."""
    return language.identify(documents(spark, sf_dir))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every text."""
    return pii.find_pii(documents(spark, sf_dir))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the bytes that they decode to, as digests."""
    out = bpe.round_trip(documents(spark, sf_dir))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", "n_tokens", F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hard negatives of each of the five positives of every hundredth
    vector; a seventh of the rows has the next label."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, label=label)


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, their faults, the cheapest edits that repair
    them, and a digest of the repaired turns."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    segs = repair.segments(repair.damaged(conversations))
    plan = repair.plans(segs)
    said = repair.reports(segs, plan)
    sums = repair.digests(repair.repaired(segs, plan)).withColumnRenamed("conv_id", "_id")
    every = conversations.select(F.col("conv_id").alias("_conv")).distinct()
    out = every.join(said, F.col("_conv").eqNullSafe(F.col("conv_id")), "left").join(sums, F.col("_conv").eqNullSafe(F.col("_id")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    return out.select(F.col("_conv").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest)


QUERIES: dict[str, Query] = {
    "op1_substring": op1_substring,
    "op2_packing": op2_packing,
    "op3_lines": op3_lines,
    "op4_minhash": op4_minhash,
    "op5_sketch": op5_sketch,
    "op6_exact": op6_exact,
    "op7_quality": op7_quality,
    "op8_mixing": op8_mixing,
    "op9_language": op9_language,
    "op10_pii": op10_pii,
    "op11_bpe": op11_bpe,
    "op12_negatives": op12_negatives,
    "op13_repair": op13_repair,
}
