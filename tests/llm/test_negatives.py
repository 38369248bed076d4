"""Hard negatives against a plain search, and packed against plain products."""

from __future__ import annotations

import math
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_features.llm import negatives
from cohort_features.llm.negatives import Kronecker, hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rid long, id long, vec string, cell int"
CLASH = (1, 2, "v", 3)


def stored(spark, rows, files=3):
    path = tempfile.mkdtemp(prefix="llm-vecs-") + "/embeddings.parquet"
    spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA).repartition(files).write.parquet(path)
    return spark.read.parquet(path)


def plain(rows, is_anchor):
    good = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) or not math.isfinite(256 * x) for x in v):
            continue
        good.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    for k, (i, v, label) in enumerate(good):
        if not is_anchor(i):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=False)), j is None, j or 0, other) for m, (j, w, other) in enumerate(good) if m != k), key=lambda x: x[:3])
        for s, null, j, _ in [x for x in scored if x[3] == label][:5]:
            fit = [x for x in scored if x[3] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            said = lambda y: y if -(2**63) <= y < 2**63 else None
            out += [(i, None if null else j, r, None if x[1] else x[2], said(-s), said(-x[0])) for r, x in enumerate(fit, 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(rng, n, dims=6, size=1.0):
    rows = []
    for i in range(n):
        v = [rng.uniform(0.2, 1) * size for _ in range(dims)]
        if rows and rng.random() < 0.3:
            v = list(rows[-1][1])  # ties
        rows.append((i, v, rng.randrange(3)))
    return rows


@pytest.mark.parametrize(("low", "high", "dims", "wide"), [(-256, 255, 64, False), (0, 1, 3, False), (-5, 900_000, 16, False), (-(10**12), 10**12, 5, True), (-(10**30), 3, 7, True)])
def test_packed_products_are_exact(low, high, dims, wide):
    layout = Kronecker(low, high, dims)
    assert layout.wide == wide
    rng = random.Random(dims)
    for n in (0, 1, 5, 70):
        a = np.array([[rng.randint(low, high) for _ in range(dims)] for _ in range(4)], dtype=layout.number)
        c = np.array([[rng.choice([low, high, rng.randint(low, high)]) for _ in range(dims)] for _ in range(n)], dtype=layout.number).reshape(n, dims)
        got = layout.scores(a, layout.pack(c))
        assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for v in c.tolist()] for u in a.tolist()]
    assert layout.fields > 1 or layout.bits > 30
    some = sorted([0, -1, 1, -(dims * max(abs(low), high) ** 2), dims * max(abs(low), high) ** 2, 7])
    assert sorted(some, key=layout.ordered) == some and [layout.score_of(layout.ordered(x)) for x in some] == some


@pytest.mark.parametrize(("size", "cells"), [(1.0, 1), (1.0, 5), (3e9, 2), (1e200, 2), (-0.5, 2)])
def test_matches_a_plain_search(spark, monkeypatch, size, cells):
    monkeypatch.setattr(negatives, "CHUNK", 17)
    monkeypatch.setattr(negatives, "TILE", 3)
    rng = random.Random(4)
    rows = vectors(rng, 130, size=size)
    table = stored(spark, rows)
    got = hard_negatives(table, F.col("vec_id") % 10 == 0, block_bytes=8 * 6 * 13 // cells, part_rows=130 // cells)
    want = plain(rows, lambda i: i is not None and i % 10 == 0)
    assert found(got) == want and len(want) > 60


def test_edge_rows(spark):
    rng = random.Random(5)
    rows = vectors(rng, 60)
    rows += [(0, rows[0][1], 1), (0, rows[0][1], 1), (None, rows[0][1], 1), (None, rows[3][1], 2)]  # repeated and null ids
    rows += [(100, None, 1), (200, [0.5] * 6, None), (300, [None, 1.0], 1), (400, [math.nan], 2), (500, [math.inf], 2), (600, [], 1), (700, [0.9, 0.1], 0), (800, [-0.5] * 6, 1)]
    got = hard_negatives(stored(spark, rows), F.col("vec_id") % 20 == 0)
    assert found(got) == plain(rows, lambda i: i is not None and i % 20 == 0)
    assert hard_negatives(stored(spark, [], 1), F.col("vec_id") % 20 == 0).count() == 0
    lone = [(0, [1.0], 0), (1, [1.0], 1)]
    assert hard_negatives(stored(spark, lone, 1), F.col("vec_id") == 0).count() == 0


def test_a_hot_label_and_equal_vectors(spark):
    rows = [(i, [0.5, 0.5], 0 if i % 3 else 1) for i in range(900)]
    got = found(hard_negatives(stored(spark, rows), F.col("vec_id") % 100 == 0))
    assert got == plain(rows, lambda i: i % 100 == 0) and len(got) == 9 * 25
