"""MinHash near-duplicates with SetSketch registers.

A document's set is its distinct word shingles. Its sketch has 144 registers
``floor(1 - log_b h)``, ``h`` the smallest of exponentially distributed hash
values (Ertl, 2021): minima on an exponential scale, truncated to 16 bits,
mergeable by maximum. 24 bands of 6 registers give the candidate buckets: a
pair of similarity 0.85 shares one with probability 1 - (1 - 0.85^6)^24 =
0.99999. A candidate pair's similarity is estimated jointly from both
registers and both set sizes by maximum likelihood; a pair 5 standard
deviations below the threshold is passed over, every other pair is verified
on the full sets. Documents with equal sets form one class first (128-bit
digest of the sorted set), so copies cost one sketch.

Defined results: null or empty texts, and texts of white space, have an empty
set and link with nothing; fewer words than a shingle make one shingle of the
whole sequence; repeated rows are documents of their own with one id; rows
without doc_id take part and have a null component id unless a linked document
has one; whole texts count, however long; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_features.llm.batches import map_rows
from cohort_features.llm.common import BROADCAST_ROWS, drop, numbered, store, with_group
from cohort_features.llm.links import connect
from cohort_features.llm.words import U, minima, mix, odd_multipliers, overlap, shingle_set, signed

BANDS, ROWS = 24, 6
REGISTERS = BANDS * ROWS
BASE, RATE, LIMIT = 1.001, 20.0, 2**16 - 2  # b, a and q of the sketch
MULTIPLIERS = odd_multipliers(REGISTERS, seed=4)


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers (uint16) of a set of 64-bit hashes; zeros if empty."""
    if not len(hashes):
        return np.zeros(REGISTERS, dtype=np.uint16)
    u = (minima(hashes, MULTIPLIERS).astype(np.float64) + 0.5) / 2.0**64
    h = -np.log1p(-np.minimum(u, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(h) / np.log(BASE)), 0, LIMIT + 1).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the union."""
    return np.maximum(a, b)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    r = regs.astype(np.uint64).reshape(BANDS, ROWS)
    key = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for i in range(ROWS):
        key = mix(key ^ (r[:, i] + U(1)) * U(0x9E3779B97F4A7C15))
    return signed(key)


def joint_estimate(regs: np.ndarray, sizes: np.ndarray, other: np.ndarray, size: int) -> np.ndarray:
    """Maximum-likelihood similarity of each row of ``regs`` with ``other``.

    With u, v the shares of both set sizes, a register is larger on the first
    side with probability u - vJ, on the second with v - uJ, equal with J."""
    more, less = (regs > other).sum(axis=1), (regs < other).sum(axis=1)
    same = regs.shape[1] - more - less
    u = sizes / (sizes + size)
    v = 1 - u
    b = same * (u * u + v * v) + more * v * v + less * u * u
    uv = u * v
    return (b - np.sqrt(np.maximum(b * b - 4 * regs.shape[1] * same * uv * uv, 0))) / (2 * regs.shape[1] * uv)


class SetMatcher:
    """Links sets with 100 * intersection >= percent * union."""

    def __init__(self, percent: int):
        self.percent = percent
        t = percent / 100
        self.floor = t - 5 * np.sqrt(t * (1 - t) / REGISTERS)

    def prepare(self, payload: bytes):
        return np.frombuffer(payload, np.uint16, REGISTERS), np.frombuffer(payload, np.uint64, offset=2 * REGISTERS)

    def stack(self, items: list):
        return np.stack([x[0] for x in items]), np.array([len(x[1]) for x in items], dtype=np.float64)

    def screen(self, stacked, item, band: int):
        regs, sizes = stacked
        n = len(item[1])
        ok = 100 * np.minimum(sizes, n) >= self.percent * np.maximum(sizes, n)
        if band and ok.any():
            ok &= ~(regs[:, : band * ROWS] == item[0][: band * ROWS]).reshape(len(regs), band, ROWS).all(axis=2).any(axis=1)
        at = np.flatnonzero(ok)
        return at[joint_estimate(regs[at], sizes[at], item[0], n) >= self.floor] if len(at) else at

    def link(self, a, b) -> bool:
        both = overlap(a[1], b[1])
        return 100 * both >= self.percent * (len(a[1]) + len(b[1]) - both)


def sketches(rows: DataFrame, shingle: int) -> DataFrame:
    """(rid, doc_id, text) to (rid, doc_id, n_shingles, set_key, bands)."""

    def run(it):
        for rid, doc_id, text in it:
            s = shingle_set(text, shingle)
            if len(s):
                yield rid, doc_id, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), band_keys(registers(s)).tolist()
            else:
                yield rid, doc_id, 0, None, []

    return map_rows(rows.select("rid", "doc_id", "text"), run, "rid long, doc_id long, n_shingles long, set_key binary, bands array<long>")


def set_payload(numbered_docs: DataFrame, shingle: int) -> DataFrame:
    """(rid, text) to (id, payload): registers and the full set."""

    def run(rows):
        for rid, text in rows:
            s = shingle_set(text, shingle)
            yield rid, registers(s).tobytes() + s.tobytes()

    return map_rows(numbered_docs.select("rid", "text"), run, "id long, payload binary")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: rid, doc_id, n_shingles, component_id (smallest
    doc_id of its group), kept (doc_id is that id), and stays (true for one row
    of each group and for every document with an empty set). ``docs`` must be
    a stored table."""
    rows = numbered(docs, "doc_id", "text")
    made = store(sketches(rows, shingle), "sketches")
    n = made.count()
    sets = made.filter("n_shingles > 0")
    classes = store(with_group(sets.select("rid", "doc_id", "set_key"), "set_key", [F.min("rid").alias("id")], rows=n), "classes")
    reps = sets.join(classes.filter("rid = id").select("rid"), "rid", "left_semi")
    keys = reps.select(F.col("rid").alias("id"), F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    members = store(keys.join(shared, "key", "left_semi"), "members")
    wanted = store(members.select(F.col("id").alias("rid")).distinct(), "wanted")
    k = wanted.count()
    few = F.broadcast(wanted) if k <= BROADCAST_ROWS else wanted
    payload = store(set_payload(rows.join(few, "rid", "left_semi"), shingle), "sets")
    comps = connect(members, payload, SetMatcher(percent))
    grouped = store(
        classes.join(comps, "id", "left").select("rid", "doc_id", F.coalesce("comp", "id").alias("comp")), "grouped"
    )
    best = [F.min("doc_id").alias("component_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("first")]
    named = with_group(grouped, "comp", best, rows=n).select("rid", "component_id", F.col("first.rid").alias("first"))
    out = made.select("rid", "doc_id", "n_shingles").join(named, "rid", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    drop(members, wanted, payload)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return out.withColumn("kept", kept).withColumn("stays", F.coalesce(F.col("first") == F.col("rid"), F.lit(True))).drop("first")
